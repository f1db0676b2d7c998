"""The index of landing files: few files are opened, and never too few."""

import json

import pytest
from pyspark.sql import functions as F

from telemere.plans import file_index, readers
from telemere.plans.landing import Landing, land_pages

WIDE = {"from_": "2024-01-01T00:00:00Z", "to": "2025-01-01T00:00:00Z"}


def event(number, message, service="api", trace=None):
    attributes = {"timestamp": f"2024-03-01T00:00:{number % 60:02d}Z", "service": service, "message": message}
    if trace:
        attributes["attributes"] = {"trace_id": trace}
    return {"id": str(number), "attributes": attributes}


def land(spark, landing, scans):
    """One file for each scan, whose page holds a list of events or is a text."""
    rows = [(scan, 0, "", b if isinstance(b, str) else json.dumps({"data": b})) for scan, b in scans.items()]
    pages = spark.createDataFrame(rows, "scan_id string, page_no long, cursor string, body string")
    land_pages(pages.coalesce(1), f"{landing.path}/landed")
    spark.read.parquet(f"{landing.path}/landed").write.mode("append").option("maxRecordsPerFile", 1).parquet(f"{landing.path}/logs")


def bodies(found):
    return sorted(r.body for r in found.select("body").collect())


@pytest.fixture
def landing(spark, tmp_path):
    place = Landing(str(tmp_path))
    events = {i: event(i, f"héllo {i}: timeout «{'abc' * i}»", f"svc-{i % 3}", f"{i + 1:032x}") for i in range(6)}
    land(spark, place, {f"s{i}": [e] for i, e in events.items()})
    file_index.index_landed(spark, place, "logs")
    return place


def test_searches_open_the_files_that_have_all_terms(spark, landing):
    def opened(**search):
        return len(file_index.candidates(spark, landing, "logs", **search).inputFiles())

    assert opened(text="héllo 3") == 1
    assert opened(facets={"service": "svc-1"}) == 2
    assert opened(facets={"service": "svc-1"}, text="llo 4: t") == 1
    assert file_index.candidates(spark, landing, "logs", text="timeout") is None  # all files have it
    assert file_index.candidates(spark, landing, "logs", text="no such").count() == 0
    assert file_index.candidates(spark, landing, "logs", text="ti") is None  # too short to tell
    assert bodies(readers.read_logs(spark, landing, text="llo 3: t", **WIDE)) == [f"héllo 3: timeout «{'abc' * 3}»"]
    found = readers.read_logs(spark, landing, {"trace_id": f"{5:032x}"}, **WIDE)
    assert bodies(found) == [f"héllo 4: timeout «{'abc' * 4}»"] and len(found.inputFiles()) == 1


def test_same_rows_with_and_without_the_index(spark, landing, tmp_path):
    texts = ["abcabc", "«»", "out «a", "", "nothing of it"]
    plain = Landing(str(tmp_path / "plain"))
    spark.read.parquet(f"{landing.path}/logs").write.parquet(f"{plain.path}/logs")
    for text in texts:
        through = bodies(readers.read_logs(spark, landing, text=text, **WIDE))
        assert through == bodies(readers.read_logs(spark, plain, text=text, **WIDE)), text


def test_files_landed_later_are_read_until_they_are_indexed(spark, landing):
    later = Landing(f"{landing.path}/later")
    land(spark, later, {"s7": [event(7, "héllo 3 again")]})
    spark.read.parquet(f"{later.path}/logs").write.mode("append").parquet(f"{landing.path}/logs")
    assert len(bodies(readers.read_logs(spark, landing, text="héllo 3", **WIDE))) == 2
    before = spark.read.parquet(f"{landing.path}/logs_index/files").count()
    file_index.index_landed(spark, landing, "logs")
    file_index.index_landed(spark, landing, "logs")
    after = spark.read.parquet(f"{landing.path}/logs_index/files")
    assert after.count() == before + 1 and after.select(F.count_distinct("file")).first()[0] == before + 1
    assert len(bodies(readers.read_logs(spark, landing, text="héllo 3", **WIDE))) == 2


def test_a_malformed_page_is_an_error_through_the_index_too(spark, landing):
    later = Landing(f"{landing.path}/later")
    land(spark, later, {"s8": "no json"})
    spark.read.parquet(f"{later.path}/logs").write.mode("append").parquet(f"{landing.path}/logs")
    file_index.index_landed(spark, landing, "logs")
    with pytest.raises(Exception, match="not valid JSON"):
        readers.read_logs(spark, landing, text="héllo 3", **WIDE).collect()
    assert len(bodies(readers.read_logs(spark, landing, text="héllo 3", on_malformed="skip", **WIDE))) == 1


def test_partitions_with_odd_names(spark, tmp_path):
    place = Landing(str(tmp_path))
    rows = [(name, f"{name}-1", 0, "", json.dumps({"data": [event(1, f"from {name}")]})) for name in ("a b:%c", "d[1]", "e")]
    pages = spark.createDataFrame(rows, "index string, scan_id string, page_no long, cursor string, body string")
    land_pages(pages, f"{place.path}/logs", ["index"])
    file_index.index_landed(spark, place, "logs")
    for name in ("a b:%c", "d[1]", "e"):
        found = readers.read_logs(spark, place, text=f"from {name}", **WIDE)
        assert bodies(found) == [f"from {name}"] and len(found.inputFiles()) == 1
        assert bodies(readers.read_logs(spark, place, text=f"from {name}", indexes=[name], **WIDE)) == [f"from {name}"]
        assert bodies(readers.read_logs(spark, place, text=f"from {name}", indexes=["other"], **WIDE)) == []
