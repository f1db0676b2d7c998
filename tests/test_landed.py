import json
import random

import pytest
from pyspark.sql import functions as F

from telemere.operators import coverage, lookups, paging
from telemere.plans import readers
from telemere.plans.landing import Landing, land_alert_pages, land_pages, write_bodies

PAGES = "scan_id string, page_no long, cursor string, body string"


def page(times, after=None, **attributes):
    events = [{"attributes": {"timestamp": t, "message": t, **attributes}} for t in times]
    meta = {"meta": {"page": {"after": after}}} if after else {}
    return json.dumps({"data": events, **meta})


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    result = action()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("rest", "rest")
    return count, result


def test_landed_chains_are_a_filter(spark, tmp_path):
    rows = [
        ("a", 0, "", page(["2024-01-01T00:00:00Z"], "1")),
        ("a", 1, "1", page(["2024-01-01T00:00:01Z"])),
        ("a", 2, "2", page(["2024-01-01T00:00:02Z"], "3")),  # behind the end
        ("b", 0, "", page(["2024-01-01T00:00:03Z"], "1")),  # not ended yet
        (None, 0, "", page(["2024-01-01T00:00:04Z"])),
    ]
    land_pages(spark.createDataFrame(rows, PAGES), f"{tmp_path}/logs")
    table = spark.read.parquet(f"{tmp_path}/logs")
    walked = paging.assemble_cursor_pages(table)
    assert "Join" not in executed(walked) and "Exchange" not in executed(walked)
    assert sorted((r.scan_id or "", r.page_no) for r in walked.collect()) == [("", 0), ("a", 0), ("a", 1), ("b", 0)]
    reading, _ = jobs(spark, "table", lambda: Landing(str(tmp_path)).table(spark, "logs"))
    calling, found = jobs(
        spark, "reader", lambda: readers.read_logs(spark, Landing(str(tmp_path)), from_="2024-01-01T00:00:00Z", to="2024-01-02T00:00:00Z")
    )
    # Only the schema of the files is looked at.
    assert calling == reading and found.count() == 4


def test_pages_of_a_walk_in_memory_need_no_job_when_called(spark):
    rows = [("a", i, str(i) if i else "", page(["2024-01-01T00:00:00Z"], str(i + 1) if i % 3 else None)) for i in range(6)]
    frame = spark.createDataFrame(rows, PAGES)
    calling, walked = jobs(spark, "raw", lambda: paging.assemble_cursor_pages(frame))
    assert calling == 0 and [r.page_no for r in walked.collect()] == [0]


def test_landed_alert_chains(spark, tmp_path):
    def groups(n, total):
        return json.dumps({"groups": [{"monitor_id": i, "status": "Alert"} for i in range(n)], "metadata": {"total_count": total}})

    rows = [("s", 0, groups(2, 3)), ("s", 1, groups(2, 3)), ("s", 2, groups(2, 3)), ("t", 0, groups(1, 9))]
    land_alert_pages(spark.createDataFrame(rows, "scan_id string, page_no long, body string"), f"{tmp_path}/alerts")
    walked = paging.assemble_offset_pages(spark.read.parquet(f"{tmp_path}/alerts"))
    assert sorted((r.scan_id, r.page_no) for r in walked.collect()) == [("s", 0), ("s", 1), ("t", 0)]
    assert "Join" not in executed(walked)


def test_a_page_across_midnight_is_found_and_others_are_skipped(spark, tmp_path):
    rows = [
        ("a", 0, "", page(["2024-01-01T23:59:59Z", "2024-01-02T00:00:01Z"])),
        ("b", 0, "", page(["2024-01-05T00:00:00Z"])),
        ("c", 0, "", page([])),
        ("d", 0, "", page(["2023-12-31T00:00:00Z"])),
    ]
    land_pages(spark.createDataFrame(rows, PAGES), f"{tmp_path}/logs", ["dt"])
    for day, n in (("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 0), ("2023-12-31", 1)):
        found = readers.read_logs(spark, Landing(str(tmp_path)), from_=f"{day}T00:00:00Z", to=f"{day}T23:59:59.999Z")
        assert found.count() == n
    plan = executed(found)
    assert "PushedFilters" in plan and "last_nanos" in plan and "PartitionFilters" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_each_instant_belongs_to_the_newest_read(spark, seed, monkeypatch):
    monkeypatch.setattr(coverage, "CELL_MS", 7)
    rng = random.Random(seed)
    reads = []
    for i in range(40):
        start = rng.randint(-30, 60)
        reads.append((f"r{i}", rng.choice("xy"), start, start + rng.choice([0, 1, 5, 30, 60]), rng.randint(0, 12)))
    frame = spark.createDataFrame(reads + reads[:5], "read string, source string, from long, to long, taken long")
    owned = {r["read"]: [(p["from"], p["to"]) for p in r["pieces"]] for r in coverage.owned_times(frame, ["source"]).collect()}
    for source in "xy":
        for t in range(-40, 130):
            covering = [(taken, read) for read, s, start, end, taken in reads if s == source and start <= t < end]
            having = [read for read, s, *_ in reads if s == source and any(a <= t < b for a, b in owned.get(read, []))]
            assert having == ([max(covering)[1]] if covering else [])


def test_an_older_overlapping_scan_gives_way(spark, tmp_path):
    schema = f"{PAGES}, index string, from_ms long, to_ms long, received_unix_nano long"
    hour = 3_600_000

    def scan(name, index, first, last, received, *seconds):
        times = [f"1970-01-01T{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}Z" for s in seconds]
        return (name, 0, "", page(times, host=name), index, first * hour, last * hour, received)

    rows = [
        scan("one", "main", 0, 2, 1, 60, 3600, 7000),
        scan("two", "main", 1, 3, 2, 3600, 7001, 8000),
        scan("audit", "audit", 0, 3, 3, 61),
        scan("early", "main", 0, 1, 0, 60, 62),
    ]
    land_pages(spark.createDataFrame(rows, schema), f"{tmp_path}/logs", ["index"])
    found = readers.read_logs(spark, Landing(str(tmp_path)), from_="0", to="36000000")
    got = sorted((r.time_unix_nano // 10**9, json.loads(r.resource_attributes)["host"]) for r in found.collect())
    assert got == [(60, "one"), (61, "audit"), (3600, "two"), (7001, "two"), (8000, "two")]


def test_alerts_resolved_in_the_newest_scan_are_gone(spark, tmp_path):
    def scan(name, received, *states):
        groups = [{"monitor_id": i, "group": "g", "status": s} for i, s in states]
        return (name, 0, json.dumps({"groups": groups}), "all", received)

    rows = [scan("a", 1, (1, "Alert"), (2, "Alert")), scan("b", 2, (1, "OK"), (3, "Warn")), scan("c", 0, (4, "Alert"))]
    frame = spark.createDataFrame(rows, "scan_id string, page_no long, body string, scope string, received_unix_nano long")
    land_alert_pages(frame, f"{tmp_path}/alerts")
    assert [r.monitor_id for r in readers.read_open_alerts(spark, Landing(str(tmp_path))).collect()] == [3]


def test_key_bitmaps_never_miss(spark):
    members = spark.range(0, 500, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(2000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    flagged = rows.where(lookups.maybe_among(lookups.key_bitmap(members, "key"), "key"))
    found = {r.id for r in flagged.collect()}
    assert {i for i in range(0, 500, 7)} <= found and len(found) < 120
    none = rows.where(lookups.maybe_among(lookups.key_bitmap(members.where("false"), "key"), "key"))
    assert none.count() == 0


def test_sums_through_the_reader_sort_nothing(spark, tmp_path):
    land_pages(spark.createDataFrame([("a", 0, "", page(["2024-01-01T00:00:00Z"], service="s"))], PAGES), f"{tmp_path}/logs")
    found = readers.read_log_stats(
        spark, Landing(str(tmp_path)), compute="sum", metric="@n", group_by=["service"], from_="2024-01-01T00:00:00Z", to="2024-01-02T00:00:00Z"
    )
    plan = executed(found)
    assert "rangepartitioning" not in plan and "Sort [time_unix_nano" not in plan


def test_pages_are_worked_out_once_when_they_land(spark, tmp_path):
    """They were rendered again for each look at their chain, which a landing of many pages spent its time on."""
    made = spark.sparkContext.accumulator(0)
    rows = [("a", i, str(i) if i else "", page(["2024-01-01T00:00:00Z"], str(i + 1) if i != 5 else None)) for i in range(8)]
    rows += [("b", i, str(i) if i else "", page(["2024-01-01T00:00:00Z"], str(i + 1))) for i in range(4)]

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    for name, kept, live in (("cut", rows, 10), ("whole", rows[8:], 4)):
        made.value = 0
        land_pages(spark.createDataFrame(kept, PAGES).mapInArrow(counted, PAGES), f"{tmp_path}/{name}")
        landed = spark.read.parquet(f"{tmp_path}/{name}")
        assert (landed.count(), landed.where("live").count(), made.value) == (len(kept), live, len(kept))


def test_bodies_lie_in_small_row_groups(spark, tmp_path):
    """Bodies that compress well made row groups of gigabytes of text, which a reader takes into memory at once."""
    import pyarrow.parquet as pq

    body = F.concat(F.lit('{"data":[{"attributes":{"message":"'), F.repeat(F.lit("x"), 50_000), F.lit('"}}]}'))
    rows = spark.range(0, 600, 1, 1).select(F.col("id").cast("string").alias("scan_id"), F.lit(0).cast("long").alias("page_no"), F.lit("").alias("cursor"), body.alias("body"))
    land_pages(rows, f"{tmp_path}/logs")
    write_bodies(rows.select("body"), f"{tmp_path}/requests")
    for kind in ("logs", "requests"):
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / kind).glob("*.parquet")]
        groups = [f.row_group(g) for f in files for g in range(f.num_row_groups)]
        assert sum(g.num_rows for g in groups) == 600 and max(g.num_rows for g in groups) <= 128
    assert spark.read.parquet(f"{tmp_path}/logs").where("live").count() == 600


def test_an_hour_is_cut_into_pages_of_the_size_a_search_gives(spark):
    """A page of all events of an hour grew with the table, and an aggregate held many of them at once."""
    from workload.landed import overlapping_scans

    rows = spark.range(2500).select(F.col("id").alias("event_id"), F.lit(86_400_000 * 3 + 13 * 3_600_000).cast("long").alias("ms"))
    event = """concat('{"id":', event_id, '}')"""
    pages = overlapping_scans(rows, event).collect()
    sizes = {(r.scan_id, r.page_no): len(json.loads(r.body)["data"]) for r in pages}
    assert len(sizes) == len(pages) == 5 and max(sizes.values()) == 1000
    assert sum(n for (scan, _), n in sizes.items() if scan == "day-3") == 2500
    assert sum(n for (scan, _), n in sizes.items() if scan == "old-2") == 1250
