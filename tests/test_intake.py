import gzip
import json
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions.time import event_time
from telemere.sources import intake
from telemere.streaming import intake as stream
from telemere.streaming import rolling


def requests(spark, *rows):
    rows = [(str(i), 10**18, r[0], r[2] if len(r) > 2 else "", r[1]) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, intake.REQUESTS)


def body(*logs):
    return json.dumps(list(logs))


JSON = "application/json"


def test_framing(spark):
    one, two = '{"message":"a"}', '{"message":"b"}'
    df = requests(
        spark,
        (JSON, body({"message": "x"}, {"message": "y"})),
        ("APPLICATION/X-NDJSON; v=1", f"{one}\n\n  \r\n{two}\n"),
        ("text/plain", f"[{one},{two}]\n{one}"),
        (None, one),
        ("application/ndjson", ""),
        (JSON, "[]"),
    )
    assessed = intake.assess(df)
    assert assessed.where("code <> 202").count() == 0
    assert sorted(r.body for r in intake.accepted_logs(assessed).collect()) == list("aaaabbxy")
    assert schemas.same_layout(intake.accepted_logs(assessed).schema, schemas.LOGS)


def test_bad_requests_contribute_nothing(spark):
    good = {"message": "g"}
    df = requests(
        spark,
        (JSON, body(good, 5)),
        (JSON, body(good) + "x"),
        (JSON, '"text"'),
        (JSON, body(*[good] * 1001)),
        ("text/plain", json.dumps(good) + "\nnope"),
        (JSON, None),
        (JSON, body(good) + " ] " + body(good)),
        (JSON, '{"a":1} ] {"b":1}'),
        (JSON, '{"a":1},{"b":1}'),
        (JSON, "{'a':1}"),
        (JSON, ""),
        (JSON, body(*[good] * 1000)),
    )
    assessed = intake.assess(df)
    rejected = {r.request_id: r.code for r in intake.rejected_requests(assessed).collect()}
    assert rejected == {str(i): 400 for i in range(11)}
    assert intake.accepted_logs(assessed).count() == 1000


def test_nested_brackets_are_not_mistaken_for_trailing_content(spark):
    df = requests(spark, (JSON, '[{"a":[[1],[2]],"message":"x"}]'), (JSON, '{"a":[{"b":1}],"message":"y"}'))
    assert sorted(r.body for r in intake.normalise_intake(df).collect()) == ["x", "y"]


def test_size_comes_before_key_and_key_before_content(spark):
    df = requests(
        spark, (JSON, "x" * 50, "bad"), (JSON, "x", "bad"), (JSON, "é" * 20, "k"), (JSON, "x", "k"), (JSON, "{}", "k")
    )
    assessed = intake.assess(df, api_key="k", max_body_bytes=39)
    codes = [r.code for r in assessed.orderBy("request_id").collect()]
    assert codes == [413, 403, 413, 400, 202]


def test_object_mapping(spark):
    log = {
        "message": {"b": 1, "a": 2},
        "timestamp": "1500",
        "dd.span_id": "s1",
        "span_id": "s2",
        "trace_id": 5,
        "status": "Warn",
        "host": "h",
        "hostname": 1,
        "ddtags": "",
        "extra": None,
        "n": 1.5,
    }
    row = intake.normalise_intake(requests(spark, (JSON, body(log)))).first()
    assert row.body == '{"b":1,"a":2}' and row.time_unix_nano == 1_500_000_000
    assert row.span_id == "s1" and row.trace_id is None and row.severity_number == 13
    assert row.resource_attributes == '{"host":"h","ddtags":[]}'
    assert json.loads(row.log_attributes) == {
        "dd.span_id": "s1", "span_id": "s2", "trace_id": 5, "extra": None, "n": 1.5,
    }
    bare = intake.normalise_intake(requests(spark, (JSON, '{"message":""}'))).first()
    assert bare.body is None and bare.log_attributes is None and bare.resource_attributes is None
    assert bare.time_unix_nano == bare.observed_time_unix_nano == 10**18


@pytest.mark.parametrize(
    "stamp, nanos",
    [
        (1700000000123, 1700000000123_000000),
        (1700000000123.25, 1700000000123_250000),
        ("-5", -5_000000),
        ("2024-01-01T00:00:00.000000001Z", 1704067200_000000001),
        ("soon", 10**18),
        (None, 10**18),
        ([1], 10**18),
    ],
)
def test_timestamps(spark, stamp, nanos):
    row = intake.normalise_intake(requests(spark, (JSON, body({"timestamp": stamp})))).first()
    assert row.time_unix_nano == nanos


def test_the_first_of_repeated_attributes_counts(spark):
    sent = '[{"message":"m","a":1,"b":{"c":1},"a":2,"b":3}]'
    assert intake.normalise_intake(requests(spark, (JSON, sent))).first().log_attributes == '{"a":1,"b":{"c":1}}'


def options(root, **extra):
    return stream.IntakeOptions(
        source=f"{root}/in", table=f"{root}/table", rejects=f"{root}/rejects", checkpoint=f"{root}/cp", **extra
    )


def test_compressed_bodies_stream_in_and_later_files_follow(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = b'{"message":"m","service":"s"}\n'
    (tmp_path / "in" / "a.gz").write_bytes(gzip.compress(line * 3))
    (tmp_path / "in" / "b.zst").write_bytes(zstandard.compress(line * 4))
    (tmp_path / "in" / "c.txt").write_bytes(b"nonsense")
    settings = options(tmp_path, layout="bodies", content_type="text/plain")
    stream.run_available(spark, "zipped", settings)
    assert spark.read.parquet(settings.table).count() == 7
    (tmp_path / "in" / "d.txt").write_bytes(line)
    stream.run_available(spark, "zipped", settings)
    assert spark.read.parquet(settings.table).count() == 8
    assert [r.code for r in spark.read.parquet(settings.rejects).collect()] == [400]


def test_lifecycle(spark, tmp_path):
    requests(spark, (JSON, body({"message": "a"}))).write.parquet(f"{tmp_path}/in")
    settings = options(tmp_path)
    first = stream.start(spark, "life", settings)
    assert stream.start(spark, "life", settings) == first
    with pytest.raises(ValueError, match="different options"):
        stream.start(spark, "life", options(tmp_path, api_key="k"))
    first.processAllAvailable()
    assert spark.read.parquet(settings.table).count() == 1
    assert stream.stop("life") == "stopped"
    assert stream.stop("life") == "not found"


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    sent = requests(spark, (JSON, body({"message": "a"}, {"message": "b"})), (JSON, "nonsense"), (JSON, "[]"))
    settings = options(tmp_path)
    store = stream.batch_writer(settings)

    def held():
        logs = spark.read.parquet(settings.table)
        assert schemas.same_layout(logs.schema, schemas.LOGS)
        return sorted(r.body for r in logs.collect()), [r.code for r in spark.read.parquet(settings.rejects).collect()]

    stream.ensure_target(spark, settings.table)
    store(sent, 0)
    store(sent, 0)
    assert held() == (["a", "b"], [400])
    store(requests(spark, (JSON, body({"message": "c"}))), 1)
    # The first batch runs once more with what it had before a failure cut it short.
    for part in (tmp_path / "table").glob("intake-*-000000000000-*.parquet"):
        part.unlink()
    assert held()[0] == ["c"]
    store(sent, 0)
    assert held() == (["a", "b", "c"], [400])


def test_one_query_reads_each_request_once(spark, tmp_path):
    requests(spark, (JSON, body({"message": "a"})), (JSON, "nonsense")).coalesce(1).write.parquet(f"{tmp_path}/in")
    query = stream.start(spark, "single", options(tmp_path))
    query.processAllAvailable()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert len([q for q in spark.streams.active if q.id == query.id]) == 1
    assert stream.stop("single") == "stopped"


def test_target_must_have_the_log_layout(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError, match="18 log columns"):
        stream.ensure_target(spark, f"{tmp_path}/other")
    with pytest.raises(ValueError, match="does not exist"):
        stream.ensure_target(spark, f"{tmp_path}/none", create=False)
    stream.ensure_target(spark, f"{tmp_path}/new")
    stream.ensure_target(spark, f"{tmp_path}/new", create=False)


def test_options_are_checked(tmp_path):
    for bad in ({"layout": "x"}, {"max_body_bytes": 0}, {"layout": "bodies", "api_key": "k"}):
        with pytest.raises(ValueError):
            options(tmp_path, **bad)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    def log(hour, name):
        return (hour * 3600 * 10**9, name)

    schema = "time_unix_nano long, severity_text string"
    name = uuid.uuid4().hex
    source = f"{tmp_path}/late"
    stamps = [[log(0, "a"), log(100, "a")], [log(1, "late"), log(90, "b"), log(130, "a")], [log(200, "z")]]
    (tmp_path / "late").mkdir()
    rows = spark.readStream.schema(schema).parquet(source)
    query = (
        rolling.rolling_stats(rows, "1 hour", group_by=("status",))
        .writeStream.format("memory").queryName(f"late_{name}").outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/cp").start()
    )
    for batch in stamps:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        query.processAllAvailable()
    query.stop()
    hours = F.unix_seconds("window_start") / 3600
    found = spark.table(f"late_{name}").select(hours.cast("int").alias("h"), "status", "n").collect()
    assert sorted(tuple(r) for r in found) == [(0, "a", 1), (90, "b", 1), (100, "a", 1), (130, "a", 1)]


def test_event_time_is_floored_to_microseconds(spark):
    df = spark.createDataFrame([(1_999,), (-1,)], "n long")
    got = [r[0] for r in df.select(F.unix_micros(event_time(F.col("n")))).collect()]
    assert got == [1, -1]
