import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemere.sinks import packing
from telemere.sinks.logs import intake_fields, intake_json, log_batches
from telemere.sinks.packing import batch_ends, pack
from telemere.sinks.spans import agent_spans, trace_batches, trace_groups
from telemere.sources.intake import normalise_intake


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 7), st.integers(1, 80))
def test_batches_cover_everything_within_limits(sizes, max_rows, max_bytes):
    ends = batch_ends(sizes, max_rows, max_bytes)
    starts = [0, *ends[:-1]] if ends else []
    assert (ends[-1] if ends else 0) == len(sizes)
    for start, end in zip(starts, ends):
        assert 0 < end - start <= max_rows
        assert sum(sizes[start:end]) <= max_bytes or end - start == 1
        if end < len(sizes) and end - start < max_rows:
            assert sum(sizes[start : end + 1]) > max_bytes


def test_packing_spans_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        items = spark.range(0, 100, 1, 3).select(
            F.to_json(F.struct("id")).alias("item"), (F.col("id") % 5 + 1).alias("n_bytes")
        )
        batches = pack(items, max_rows=10, max_bytes=25).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ids = [entry["id"] for b in batches for entry in json.loads(b.body)]
    assert sorted(ids) == list(range(100)) and len({b.batch_id for b in batches}) == len(batches)
    assert all(b.n_rows == len(json.loads(b.body)) <= 10 and b.n_bytes <= 25 for b in batches)
    # Nearly full batches: only the last one of each partition may be short.
    assert len(batches) <= 100 * 3 / 25 * 1.5 + 3


def one_log(spark, **columns):
    df = spark.createDataFrame([tuple(columns.values())], list(columns))
    return json.loads(intake_json(intake_fields(df)).first().item)


def test_log_fields_by_name_and_fallback(spark):
    assert one_log(spark, Message="m", SERVICE="s", status="", severity_number=18, x=1) == {
        "message": "m", "service": "s", "status": "error", "ddsource": "spark",
    }
    assert one_log(spark, body="b", message="m", host="h", hostname="hn")["hostname"] == "hn"
    assert one_log(spark, time_unix_nano=1_999_999, timestamp=5)["timestamp"] == 1
    assert one_log(spark, timestamp=5)["timestamp"] == 5
    assert one_log(spark, timestamp="1970-01-01T00:00:01Z")["timestamp"] == 1000
    assert one_log(spark, timestamp="soon", observed_time_unix_nano=7_000_000)["timestamp"] == 7
    assert one_log(spark, time_unix_nano=-1_500_000)["timestamp"] == -1


def test_resource_is_mined_and_reserved_keys_win(spark):
    resource = '{"host":"r","ddtags":["a:1",5,"b:2"],"z":{"y":1,"x":2}}'
    got = one_log(
        spark,
        message="m",
        resource_attributes=resource,
        log_attributes='{"message":"no","hostname":"no","resource_attributes":1,"status":"free","k":{"a":[1]}}',
    )
    assert got == {
        "message": "m", "ddsource": "spark", "hostname": "r", "ddtags": "a:1,b:2",
        "resource_attributes": json.loads(resource), "status": "free", "k": {"a": [1]},
    }
    assert one_log(spark, hostname="mine", resource_attributes=resource)["hostname"] == "mine"
    broken = one_log(spark, message="m", resource_attributes="{bad", log_attributes="[1]")
    assert broken == {"message": "m", "ddsource": "spark"}


def test_sent_logs_arrive(spark):
    df = spark.createDataFrame(
        [
            ("checkout failed", "payment", "ERROR", "trace-1", '{"duration_ns": "5000000000"}'),
            ("checkout ok", "payment", "INFO", "trace-2", '{"duration_ns": "120000"}'),
        ],
        "body string, service_name string, severity_text string, trace_id string, log_attributes string",
    )
    sent = log_batches(df).select(
        F.col("batch_id").alias("request_id"),
        F.lit(1).cast("long").alias("received_unix_nano"),
        F.lit("application/json").alias("content_type"),
        F.lit("").alias("api_key"),
        "body",
    )
    rows = normalise_intake(sent).orderBy("trace_id").collect()
    assert [(r.trace_id, r.service_name, r.severity_text, r.body) for r in rows] == [
        ("trace-1", "payment", "ERROR", "checkout failed"),
        ("trace-2", "payment", "INFO", "checkout ok"),
    ]
    assert all("duration_ns" in r.log_attributes for r in rows)


SPAN = "trace_id string, span_id string, start_time_unix_nano long, span_attributes string, resource_attributes string"


def test_span_attributes_are_typed_and_never_overwritten(spark):
    attributes = json.dumps(
        {"span.kind": "mine", "n": 5, "f": 1.5, "t": True, "o": {"z": 1, "a": [2]}, "nil": None, "_dd.p.tid": "x"}
    )
    resource = json.dumps({"n": "later", "nil": "kept", "host": "h"})
    df = spark.createDataFrame(
        [("463ac35c9f6413ad48485a3953bb6124", "1", 5, attributes, resource)], SPAN
    ).withColumn("kind", F.lit(2))
    row = agent_spans(df).first()
    assert row.outcome == "ok" and row.trace_id_high == "463ac35c9f6413ad" and row.type == "web"
    assert row.meta == {
        "_dd.p.tid": "463ac35c9f6413ad", "span.kind": "server", "t": "true", "o": '{"z":1,"a":[2]}',
        "nil": "kept", "host": "h",
    }
    assert row.metrics == {"n": 5.0, "f": 1.5}
    assert (row.service, row.name, row.resource) == ("unknown-service", "unnamed_operation", "unnamed_operation")


def test_outcomes_report_the_first_failing_check(spark):
    rows = [("1", "2", 3), (None, "x", None), ("1", "", None), ("1", "2", None), ("z", "2", 3)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, start_time string").withColumn(
        "start_time", F.col("start_time").cast("long")
    )
    skipped = "skipped: missing or invalid "
    assert [r.outcome for r in agent_spans(df).collect()] == [
        "ok", skipped + "trace_id", skipped + "span_id", skipped + "start_time_unix_nano", skipped + "trace_id",
    ]


def test_integer_ids_and_parents(spark):
    df = spark.createDataFrame(
        [(5, 7, 0, 1, -3), (-5, 7, 9, 1, 3)], "trace_id long, span_id long, parent_id long, start long, duration long"
    )
    good, bad = agent_spans(df).collect()
    assert (int(good.trace_id), int(good.span_id), good.parent_id, good.duration) == (5, 7, None, 0)
    assert bad.outcome.endswith("trace_id")


def test_sender_needs_ids(spark):
    with pytest.raises(ValueError, match="trace_id and span_id"):
        agent_spans(spark.range(1))


def test_traces_with_equal_low_bits_stay_apart(spark):
    rows = [("a" + "0" * 15 + "1", "1", 3), ("b" + "0" * 15 + "1", "2", 2), ("a" + "0" * 15 + "1", "3", 1)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, start_time_unix_nano long")
    groups = trace_groups(agent_spans(df)).orderBy("trace_id_high").collect()
    assert [(g.trace_id_high, g.n_spans) for g in groups] == [("a", 2), ("b", 1)]
    assert [s["span_id"] for s in json.loads(groups[0].body)] == [3, 1]
    batch = trace_batches(df).collect()
    assert sum(b.n_rows for b in batch) == 2


def test_a_large_trace_is_one_array_and_counts_once(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 2500, F.lit("1")).otherwise(F.hex("id")).alias("trace_id"),
        F.hex("id").alias("span_id"),
        (10_000 - F.col("id")).alias("start_time_unix_nano"),
    )
    groups = trace_groups(agent_spans(rows)).collect()
    assert len(groups) == 2501 and max(g.n_spans for g in groups) == 2500
    large = next(g for g in groups if g.n_spans == 2500)
    starts = [span["start"] for span in json.loads(large.body)]
    assert starts == sorted(starts) and large.start == starts[0]
    assert sum(b.n_rows for b in trace_batches(rows).collect()) == 2501


def test_an_array_beyond_the_bound_goes_on_in_parts(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") < 700, F.lit("1")).otherwise(F.hex(F.col("id") % 7 + 16)).alias("trace_id"),
        F.hex(F.col("id") + 1).alias("span_id"),
        F.col("id").alias("start_time_unix_nano"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        groups = trace_groups(agent_spans(rows), max_bytes=5000).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    first = [g for g in groups if g.part == 0]
    assert len({(g.trace_id_high, g.trace_id) for g in groups}) == len(first) == 8
    large = sorted((g for g in groups if g.trace_id == 1), key=lambda g: g.part)
    assert [g.part for g in large] == list(range(len(large))) and len(large) > 10
    spans = [span["span_id"] for g in large for span in json.loads(g.body)]
    assert spans == list(range(1, 701)) and all(len(g.body) <= 5100 for g in large)
    assert sum(g.n_spans for g in groups) == 900



def test_repeated_attributes_are_sent_once(spark):
    from telemere.sinks.logs import intake_fields, intake_json

    df = spark.createDataFrame([("m", '{"a":1,"z":true,"a":2}')], "body string, log_attributes string")
    item = intake_json(intake_fields(df)).first().item
    assert item.count('"a"') == 1 and json.loads(item)["a"] == 1 and json.loads(item)["z"] is True


def test_batches_of_long_items_are_joined_in_slices(spark, monkeypatch):
    """A batch handed over is joined a slice at a time, and the bodies are those of one pass."""
    rows = [(f'"{n:03d}{"x" * (n % 7 * 40)}"', n % 7 * 40 + 5) for n in range(300)]
    items = spark.createDataFrame(rows, "item string, n_bytes long").coalesce(1)

    def whole(size):
        monkeypatch.setattr(packing, "SLICE_BYTES", size)
        return [(r.body, r.n_rows, r.n_bytes) for r in packing.pack(items, 40, 2000).collect()]

    assert whole(500) == whole(1 << 30)


def test_entries_of_repeated_and_null_keys(spark):
    """The first of a repeated key counts, nulls claim no key of a later source, and text stays as it was sent."""
    span = '{"a":1,"a":"two","n":null,"o":{"z":1,"b":[1,"2"]},"t":true,"s":"5"}'
    df = spark.createDataFrame(
        [("1", "2", 5, span, '{"a":3,"n":4.5,"s":6,"e":""}'), ("1", "2", 5, "[1]", "{bad")],
        "trace_id string, span_id string, start long, span_attributes string, resource_attributes string",
    )
    first, second = agent_spans(df).select("meta", "metrics").collect()
    assert first.meta == {"o": '{"z":1,"b":[1,"2"]}', "t": "true", "s": "5", "e": ""}
    assert first.metrics == {"a": 1.0, "n": 4.5}
    assert second.meta == {} and second.metrics == {}


def test_filter_by_outcome_stays_above_the_ids(spark):
    df = spark.createDataFrame([("ab", "2", 5)], "trace_id string, span_id string, start long")
    plan = agent_spans(df).where("outcome = 'ok'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate inline")


def test_ids_are_worked_out_before_the_generator(spark):
    """Inside it they would run expression by expression, the outcome's parts once more."""
    df = spark.createDataFrame([("ab", "2", 5)], "trace_id string, span_id string, start long")
    plan = agent_spans(df)._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "Generate inline" in x)
    assert "conv(" not in line and "conv(" in plan
