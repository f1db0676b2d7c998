import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemere import schemas
from telemere.operators import correlate, groups, lookups, paging, search, stats
from telemere.operators.stats import StatsOptions
from telemere.plans import readers


def test_cursor_chain_ends(spark):
    rows = [
        ("plain", 0, "", "1", 2), ("plain", 1, "1", None, 2),
        ("stuck", 0, "", "1", 2), ("stuck", 1, "1", "1", 2), ("stuck", 2, "1", "3", 2),
        ("empty", 0, "", "1", 2), ("empty", 1, "1", "2", 0), ("empty", 2, "2", "3", 2),
        ("blank", 0, "", "", 2), ("blank", 1, "1", "2", 2),
        ("open", 0, "", "1", 2),
    ]
    pages = spark.createDataFrame(rows, "scan_id string, page_no long, cursor string, after string, n_rows long")
    kept = paging.assemble_cursor_pages(pages).groupBy("scan_id").count().collect()
    assert {r.scan_id: r["count"] for r in kept} == {"plain": 2, "stuck": 2, "empty": 2, "blank": 1, "open": 1}


def test_running_total_over_many_blocks(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("k"), "id", (F.col("id") % 7).alias("v")
    )
    got = paging.running_total(df, "k", "id", "v").orderBy("id").select("running_total").collect()
    values = [i % 7 for i in range(5000)]
    expected = list(np.cumsum(values[:4000])) + list(np.cumsum(values[4000:]))
    assert [r[0] for r in got] == expected


def test_offset_chain_ends(spark):
    rows = [
        ("total", 0, 100, 150), ("total", 1, 100, 150), ("total", 2, 100, 150),
        ("short", 0, 100, None), ("short", 1, 99, None), ("short", 2, 100, None),
        ("empty", 0, 0, 500), ("empty", 1, 5, 500),
    ]
    pages = spark.createDataFrame(rows, "scan_id string, page_no long, n_rows long, total_count long")
    kept = paging.assemble_offset_pages(pages).groupBy("scan_id").count().collect()
    assert {r.scan_id: r["count"] for r in kept} == {"total": 2, "short": 2, "empty": 1}


def test_cap_comes_before_filters(spark):
    df = spark.range(1000).select(F.col("id").alias("time_unix_nano"), (F.col("id") % 10).alias("g"))
    assert paging.cap_rows(df, 100).where("g = 0").count() == 10
    assert paging.cap_rows(df, 100, descending=True).agg(F.min("time_unix_nano")).first()[0] == 900
    assert paging.cap_rows(df, 0).count() == 1000
    with pytest.raises(ValueError):
        paging.cap_rows(df, -1)


@pytest.mark.parametrize("n", [1, 499, 500, 501, 1500, 2100, 5000])
@pytest.mark.parametrize("descending", [False, True])
def test_large_caps_are_exact(spark, n, descending):
    # A third of the rows share one instant, some lie before 1970, some have no time.
    moment = (
        F.when(F.col("id") < 500, F.col("id") * 7_777_777_777_777 - 10**15)
        .when(F.col("id") < 1200, F.lit(3_600_000_000_001))
        .when(F.col("id") < 2000, F.col("id") * 1_000_001)
    )
    df = spark.range(2100).select("id", moment.alias("time_unix_nano"))
    order = F.desc_nulls_last("time_unix_nano") if descending else F.asc_nulls_last("time_unix_nano")
    expected = [r[0] for r in df.orderBy(order).limit(n).select("time_unix_nano").collect()]
    got = paging.cap_rows(df, n, descending=descending, tiebreak=("id",))
    times = [r[0] for r in got.select("time_unix_nano").collect()]

    def key(t):
        return (t is None, t or 0)

    assert sorted(times, key=key) == sorted(expected, key=key)


def test_sub_windows(spark):
    rows = [tuple(r) for r in paging.sub_windows(spark, 0, 10, 4).orderBy("window_no").collect()]
    assert rows == [(0, 0, 4), (1, 4, 8), (2, 8, 10)]


def test_lookup_is_broadcast_only_when_small(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    facts = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small_plan = facts.join(lookups.bounded(big, 1000), "k")._jdf.queryExecution().toString()
        large_plan = facts.join(lookups.bounded(big, 999), "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small_plan and "BroadcastHashJoin" not in large_plan


def test_top_k_of_a_dominant_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4500, "hot").otherwise("cold").alias("g"), "id")
    top = groups.top_k_per_group(df, ["g"], [F.desc("id")], 3, ["id"]).collect()
    assert sorted(r.id for r in top) == [4497, 4498, 4499, 4997, 4998, 4999]


@pytest.mark.parametrize("p", [0.0, 0.75, 0.99, 1.0])
def test_percentiles_are_exact_on_large_skewed_groups(spark, p):
    df = spark.range(60_000).select(
        F.when(F.col("id") < 50_000, "hot").when(F.col("id") < 59_999, "warm").otherwise("one").alias("g"),
        # Heavy ties in the middle, long tails, and some missing values.
        F.when(F.col("id") % 3 == 0, F.lit(5.0))
        .when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.pow(F.lit(1.0005), F.col("id") % 20_011) - 3)
        .cast("double")
        .alias("v"),
    )
    expected = {
        k: np.percentile(v.dropna(), p * 100) for k, v in df.toPandas().groupby("g")["v"]
    }
    found = groups.exact_percentile(groups.counted_values(df, ["g"], "v"), ["g"], "v", p).collect()
    got = {r.g: r.value for r in found}
    assert len(found) == len(got) and got.keys() == expected.keys()
    for name in got:
        assert got[name] == pytest.approx(expected[name], rel=1e-12)
    total = groups.exact_percentile(groups.counted_values(df, [], "v"), [], "v", p).first()[0]
    assert total == pytest.approx(np.percentile(df.toPandas()["v"].dropna(), p * 100), rel=1e-12)


def log_rows(spark, rows):
    columns = "service_name string, severity_text string, log_attributes string, resource_attributes string"
    return spark.createDataFrame(rows, columns)


def test_stats_limits_each_facet_in_turn(spark):
    rows = [("a", "x", None, None)] * 3 + [("a", "y", None, None)] * 2 + [("a", "z", None, None)]
    rows += [("b", "x", None, None)] * 2 + [("c", "x", None, None), (None, "x", None, None)]
    got = stats.log_stats(log_rows(spark, rows), group_by=["service", "status"], group_limit=2).collect()
    assert {(r.by, r.value) for r in got} == {
        ('{"service":"a","status":"x"}', 3.0),
        ('{"service":"a","status":"y"}', 2.0),
        ('{"service":"b","status":"x"}', 2.0),
    }


def test_stats_limits_too_large_to_broadcast(spark):
    rows = [(f"s{i % 40}", f"t{i % 7}", None, None) for i in range(2000)]
    df = log_rows(spark, rows)
    small = stats.log_stats(df, group_by=["service", "status", "service"], group_limit=300)
    large = stats.log_stats(df, group_by=["service", "status", "service"], group_limit=10_000)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_stats_of_nothing(spark):
    empty = log_rows(spark, [])
    assert [tuple(r) for r in stats.log_stats(empty).collect()] == [("{}", 0.0)]
    for compute in ("pc95", "avg", "sum", "max"):
        assert stats.log_stats(empty, compute=compute, metric="@d").collect()[0].value is None
    assert stats.log_stats(empty, group_by=["service"]).count() == 0


@pytest.mark.parametrize("compute", ["pc90", "cardinality"])
def test_approximate_stats(spark, compute):
    rows = [("a", "x", f'{{"d":{i}}}', None) for i in range(1000)]
    got = stats.log_stats(log_rows(spark, rows), compute=compute, metric="@d", approx=True).first().value
    assert got == pytest.approx(900 if compute == "pc90" else 1000, rel=0.1)


@pytest.mark.parametrize(
    "arguments, message",
    [
        ({"compute": "cardinality"}, "Name a facet"),
        ({"compute": ""}, "no compute given"),
        ({"compute": "median", "metric": "@d"}, "there is no compute"),
        ({"group_limit": 0}, "from 1 to 10000"),
        ({"group_limit": 10_001}, "from 1 to 10000"),
        ({"group_by": [""]}, "no facet name"),
        ({"group_by": [None]}, "no facet name"),
        ({"retries": -1}, "retries is negative"),
        ({"timeout": 0}, "timeout is below"),
    ],
)
def test_stats_arguments_are_checked(arguments, message):
    with pytest.raises(ValueError, match=message):
        StatsOptions(**arguments)


def test_dotted_attribute_facets(spark):
    rows = [(None, None, '{"http":{"code":1}}', None), (None, None, '{"http.code":2}', None), (None, None, None, None)]
    df = log_rows(spark, rows).select(search.facet("@http.code"))
    assert [r[0] for r in df.collect()] == ["1", "2", None]


def test_empty_window_is_an_empty_relation(spark):
    from telemere.functions.window import Window

    df = spark.range(5).withColumnRenamed("id", "time_unix_nano")
    assert search.where_window(df, Window(5, 4, "ms")).count() == 0
    with pytest.raises(ValueError, match="sort"):
        search.sorted_by(df, "newest")


SPANS = "trace_id string, span_id string, parent_span_id string, service_name string, status_code int, " \
    "start_time_unix_nano long, duration_time_unix_nano long, name string"


def test_edges_with_a_dominant_parent(spark):
    rows = [("t", "p", None, "web", 0, 10**9, 5, "root")]
    rows += [("t", f"c{i}", "p", "db" if i % 2 else "web", 2 if i % 3 == 0 else 0, 2 * 10**9, 10, "c") for i in range(600)]
    rows += [("u", "x", "p", "db", 0, 1, 1, "orphan")]
    edge = correlate.edges_from_spans(spark.createDataFrame(rows, SPANS), "acme", "prod").collect()
    assert len(edge) == 1
    assert (edge[0].source_service, edge[0].target_service) == ("web", "db")
    assert (edge[0].request_count, edge[0].error_count) == (300, 100)
    assert edge[0].total_response_time_seconds == pytest.approx(3e-6)
    assert schemas.same_layout(
        correlate.edges_from_spans(spark.createDataFrame(rows, SPANS), "a", "b").schema, schemas.DEPENDENCIES
    )


def test_logs_without_ids_skip_the_join_and_never_multiply(spark):
    spans = spark.createDataFrame([("t", f"s{i}", None, "web", 0, i, 1, "n") for i in range(50)], SPANS)
    logs = spark.createDataFrame([("t", "s1"), ("t", "zz"), (None, None), ("q", None)], "trace_id string, span_id string")
    assert correlate.with_trace(logs, spans).count() == 4
    assert correlate.with_span(logs, spans).where("span_name is not null").count() == 1
    assert correlate.logs_with_spans(logs, spans).count() == 2
    assert correlate.logs_without_spans(logs, spans).count() == 2


def test_latest_state_prunes_before_the_shuffle(spark):
    rows = [(1, "g", "Alert", 1), (1, "g", "OK", 2), (1, "h", "OK", 1), (1, "h", "Warn", 2)]
    df = spark.createDataFrame(rows, "monitor_id long, group_name string, status string, observed_unix_nano long")
    latest = correlate.latest_state(df)
    assert [(r.group_name, r.status) for r in latest.collect()] == [("h", "Warn")]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().toString()


def test_edge_maps_combine_by_name(spark):
    one = spark.createDataFrame([], schemas.DEPENDENCIES)
    two = spark.createDataFrame([("x", "a", "b")], "provider string, source_service string, target_service string")
    assert correlate.union_edges(one, two).columns == schemas.DEPENDENCIES.fieldNames()


def test_percentile_of_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), ("b", 2.0)], "g string, v double")
    got = {r.g: r.value for r in groups.exact_percentile(groups.counted_values(df, ["g"], "v"), ["g"], "v", 0.5).collect()}
    assert got == {"a": None, "b": 1.5}


@pytest.mark.parametrize("p", [0.0, 0.4, 0.75, 1.0])
def test_percentiles_of_values_of_every_size(spark, p):
    one = 1.0
    neighbours = [np.nextafter(one, 2, dtype=float)]
    for _ in range(40):
        neighbours.append(np.nextafter(neighbours[-1], 2))
    tiny = [5e-324 * i for i in range(1, 9)]
    values = [*neighbours, *tiny, *[-x for x in neighbours], 0.0, -0.0, 1e308, -1e308, 1.7e-300, 3.0, 3.0, 3.0]
    df = spark.createDataFrame([(float(v), "a" if i % 2 else "b") for i, v in enumerate(values)], "v double, g string")
    ordered = sorted(values)
    rank = (len(ordered) - 1) * p
    low, high = ordered[int(np.floor(rank))], ordered[int(np.ceil(rank))]
    got = groups.exact_percentile(groups.counted_values(df, [], "v"), [], "v", p).first()[0]
    assert got == low + (rank - np.floor(rank)) * (high - low)


def test_percentiles_sort_histograms_only_and_read_the_rows_once(spark):
    rows = log_rows(spark, [("a", "x", '{"d":1}', None), ("b", "x", '{"d":2}', None)])
    result = stats.log_stats(rows, compute="pc95", metric="@d", group_by=["service", "status"])
    assert result.count() == 2
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "raise_error" not in plan and "percentile" not in plan
    result = stats.log_stats(rows, compute="pc95", metric="@d")
    result.collect()
    single = [line for line in result._jdf.queryExecution().executedPlan().toString().splitlines() if "SinglePartition" in line]
    # Only counts by bin, or the states found from them, meet in one task.
    assert single and all("_v" not in line for line in single)


def test_no_operator_needs_a_cross_join(spark):
    rows = log_rows(spark, [("a", "x", '{"d":1}', None)])
    plan = stats.log_stats(rows, compute="pc95", metric="@d")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cap_is_the_same_at_every_size_and_on_every_read(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 7).alias("time_unix_nano"),
        F.col("id").alias("n"),
        F.lit("x").alias("same"),
    )
    previous = set()
    for cap in (1, 500, 20_000, 29_500):
        got = {r.n for r in paging.cap_rows(rows, cap).collect()}
        assert len(got) == cap and previous <= got
        assert got == {r.n for r in paging.cap_rows(rows.repartition(3, "n"), cap).collect()}
        previous = got


def test_cap_between_equal_rows(spark):
    rows = spark.range(1000).select(F.lit(5).cast("long").alias("time_unix_nano"), F.lit("a").alias("body"))
    assert paging.cap_rows(rows, 300).count() == 300
    assert paging.cap_rows(rows, 1000).count() == 1000


def test_redelivered_spans_count_once(spark):
    span = "trace_id string, span_id string, parent_span_id string, service_name string, status_code int, "
    span += "duration_time_unix_nano long, start_time_unix_nano long, name string"
    rows = [("t", "a", None, "web", 0, 5, 1, "root"), ("t", "b", "a", "db", 2, 3, 2, "call")]
    spans = spark.createDataFrame([*rows, *rows, rows[1]], span)
    (edge,) = correlate.edges_from_spans(spans, "p", "e").collect()
    assert (edge.request_count, edge.error_count) == (1, 1)
    logs = spark.createDataFrame([("t", "b", "hello")], "trace_id string, span_id string, body string")
    assert correlate.with_span(logs, spans).count() == 1


def test_a_trace_with_a_third_of_the_logs_is_in_no_single_task(spark):
    hot = F.col("id") % 3 == 0
    ids = spark.range(30_000).select("id", F.when(hot, F.lit("hot")).otherwise(F.hex("id")).alias("trace_id"))
    logs = ids.select(
        F.col("id").alias("time_unix_nano"), F.lit(0).alias("observed_time_unix_nano"), "trace_id",
        F.hex("id").alias("span_id"), F.concat(F.lit("m"), "id").alias("body"),
    )
    spans = spark.range(9000).select(
        F.when(F.col("id") % 9 == 0, F.lit("hot")).otherwise(F.hex("id")).alias("trace_id"), F.hex("id").alias("span_id"),
        F.lit("s").alias("service_name"), F.lit("n").alias("name"), F.lit(0).alias("status_code"),
        F.col("id").alias("start_time_unix_nano"), F.lit(1).alias("duration_time_unix_nano"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = correlate.with_trace(logs, spans).where("trace_id = 'hot'")
        by_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.max("span_count").alias("spans"))
        tasks = by_task.collect()
        semi, anti = (f(logs, spans).count() for f in (correlate.logs_with_spans, correlate.logs_without_spans))
        named = correlate.with_span(logs, spans).where("span_name is not null").count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(t.n for t in tasks) == 10_000 and max(t.n for t in tasks) < 1200 and len(tasks) > 20
    assert {t.spans for t in tasks} == {1000}
    assert semi + anti == 30_000 and semi == 10_000 + sum(i % 3 != 0 and i % 9 != 0 for i in range(9000))
    # A span answers for a log of its own trace and id.
    assert named == sum((i % 3 == 0) == (i % 9 == 0) for i in range(9000))


def test_a_spread_join_never_broadcasts_its_lookup(spark):
    """The size guessed for the lookup may be far too small; the driver must not hold it."""
    logs = spark.range(50).selectExpr("cast(id as string) as trace_id", "id as time_unix_nano")
    spans = spark.range(20, 30).selectExpr("cast(id as string) as trace_id")
    for relation in (correlate.logs_with_spans, correlate.logs_without_spans):
        joined = relation(logs, spans)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert joined.count() == (10 if relation is correlate.logs_with_spans else 40)


def test_correlations_read_their_relations_no_more_often_than_needed(spark, tmp_path):
    """JSON is taken apart by each read: spans are read once."""
    spark.range(40).selectExpr("cast(id as string) trace_id", "id time_unix_nano", "cast(id as string) span_id").write.parquet(f"{tmp_path}/logs")
    rows = [("t", "p", None, "a"), ("t", "c", "p", "b"), ("t", "c", "p", "b"), ("t", None, "p", "b"), ("t", None, "p", "b"), (None, "x", "p", "b")]
    spans = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, service_name string")
    spans.selectExpr(
        "*", "'n' as name", "0 as status_code", "7L as start_time_unix_nano", "1L as duration_time_unix_nano"
    ).write.parquet(f"{tmp_path}/spans")
    logs, spans = spark.read.parquet(f"{tmp_path}/logs"), spark.read.parquet(f"{tmp_path}/spans")
    edges = correlate.edges_from_spans(spans, "acme", "prod")
    assert [(r.source_service, r.target_service, r.request_count) for r in edges.collect()] == [("a", "b", 3)]
    assert correlate.one_per_span(spans, "service_name").count() == 5

    edges.collect()
    final = edges._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet[^\n]*service_name", final)) == 1
    named = correlate.with_span(logs, spans)
    planned = named._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet[^\n]*service_name", planned)) == 1
    assert named.count() == 40


def test_time_of_an_overlapping_read_is_not_read_for_each_piece(spark):
    rows = spark.range(1).selectExpr(
        """'{"t":5000000}' as doc""", "0L as _from", "9L as _to", "array(named_struct('from', 1L, 'to', 4L), named_struct('from', 4L, 'to', 9L)) as _pieces"
    )
    timed = rows.repartition(1).withColumn("t", F.get_json_object("doc", "$.t").cast("long"))
    kept = readers._covered(timed, "t")
    filters = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 1 and "exists(" in filters
    assert "get_json_object" not in filters.split("exists(")[1].split("\n")[0]
