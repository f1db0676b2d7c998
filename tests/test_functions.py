from decimal import Decimal

from pyspark.sql import functions as F

from telemere.functions import json as J
from telemere.functions import otel, time


def values(spark, expression, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select(expression(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_severity_both_ways(spark):
    statuses = ["TRACE", "debug", "Notice", "warning", "ERR", "fatal", "nonsense", "", None]
    assert values(spark, otel.status_to_severity, statuses) == [1, 5, 9, 13, 17, 21, 0, 0, None]
    numbers = [0, 1, 4, 5, 12, 13, 20, 21, 24, 25]
    expected = ["", "trace", "trace", "debug", "info", "warn", "error", "critical", "critical", ""]
    assert values(spark, otel.severity_to_status, numbers, "int") == expected


def test_span_kinds(spark):
    names = ["SPAN_KIND_SERVER", "client", "Producer", "consumer", "internal", "other", None]
    assert values(spark, otel.kind_to_int, names) == [2, 3, 4, 5, 1, 0, None]
    assert values(spark, otel.int_to_kind, [1, 2, 5, 0, 6], "bigint") == [
        "internal", "server", "consumer", None, None,
    ]


def test_hex_ids(spark):
    ids = [
        "00000000000000018",
        "0x18",
        "463ac35c9f6413ad48485a3953bb6124",
        "ABCDEF",
        " ff\t",
        "",
        "0x",
        "xyz",
        "0" * 33,
        "f" * 16,
        None,
    ]
    digits = spark.createDataFrame([(i, r) for i, r in enumerate(ids)], "i int, x string").orderBy("i")
    got = digits.select(otel.hex_digits(F.col("x")).alias("d")).select(
        otel.hex_low(F.col("d")), otel.hex_high(F.col("d"))
    )
    assert [tuple(r) for r in got.collect()] == [
        (Decimal(0x18), ""),
        (Decimal(0x18), ""),
        (Decimal(0x48485A3953BB6124), "463ac35c9f6413ad"),
        (Decimal(0xABCDEF), ""),
        (Decimal(255), ""),
        (None, None),
        (None, None),
        (None, None),
        (None, None),
        (Decimal(2**64 - 1), ""),
        (None, None),
    ]


def test_iso_times(spark):
    texts = [
        "2026-07-07T10:30:45.123456789Z",
        "2026-07-07 10:30:45+02:00",
        "2026-07-07",
        "2026-07-07T10:30:45",
        "1969-12-31T23:59:59.9Z",
        "10:30",
        "2026-13-01T00:00:00Z",
        "1600-01-01T00:00:00Z",
        "soon",
        None,
    ]
    base = 1783420245_000000000
    expected = [
        base + 123456789,
        base - 7200_000000000,
        1783382400_000000000,
        base,
        -100_000_000,
        None,
        None,
        None,
        None,
        None,
    ]
    assert values(spark, time.iso_to_nanos, texts) == expected


def test_iso_times_do_not_depend_on_the_session_zone(spark):
    texts = ["2026-07-07", "2026-07-07T10:30:45", "2026-07-07T10:30:45Z", "2026-07-07 10:30:45-01:00"]
    expected = values(spark, time.iso_to_nanos, texts)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, time.iso_to_nanos, texts) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_millisecond_rounding_at_the_extremes(spark):
    nanos = [0, 1, -1, 1_000_000, -1_000_001, 2**63 - 1, -(2**63)]
    assert values(spark, time.floor_ms, nanos, "bigint") == [n // 1_000_000 for n in nanos]
    assert values(spark, time.ceil_ms, nanos, "bigint") == [-(-n // 1_000_000) for n in nanos]
    cut = [abs(n) // 1_000_000 * (1 if n >= 0 else -1) for n in nanos]
    assert values(spark, time.truncate_ms, nanos, "bigint") == cut


def test_strict_json_types(spark):
    docs = ['{"s":"a"}', '{"s":5}', '{"s":null}', '{"s":{"a":1}}', "{}", "not json", None]

    def text(c):
        return J.string_at(J.parse(c), "$.s")

    def number(c):
        return J.number_at(J.parse(c), "$.s")

    assert values(spark, text, docs) == ["a", None, None, None, None, None, None]
    assert values(spark, number, docs) == [None, 5.0, None, None, None, None, None]


def test_object_text_keeps_source_order_and_rejects_text_that_looks_like_an_object(spark):
    docs = ['{"c":{"z":1,"a":{"y":2,"b":3}}}', '{"c":"{\\"a\\":1}"}', '{"c":{}}', '{"c":[1]}']
    got = values(spark, lambda c: J.object_text(J.parse(c), c, "$.c"), docs)
    assert got == ['{"z":1,"a":{"y":2,"b":3}}', None, "{}", None]


def test_tags(spark):
    df = spark.createDataFrame([(["a:1", "host:", "service_name_x:9", "ns:2", "b.c:3:4"],)], "t array<string>")
    row = df.select(
        otel.tag_value(F.col("t"), "host"),
        otel.tag_value(F.col("t"), "b.c", "ns"),
        otel.tag_value(F.col("t"), "b.c"),
        otel.tag_value(F.col("t"), "none"),
    ).first()
    assert tuple(row) == (None, "2", "3:4", None)
    assert values(spark, otel.split_tags, ["a:1, b:2,, ", "", None]) == [["a:1", "b:2"], [], None]


def test_merge_never_overwrites(spark):
    df = spark.sql("select map('a', 1, 'b', 2) x, map('b', 9, 'c', 3) y, map('a', 9, 'c', 9, 'd', 4) z")
    merged = df.select(J.merge_first_wins(F.col("x"), F.col("y"), F.col("z"))).first()[0]
    assert merged == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_log_size_counts_bytes(spark):
    assert values(spark, lambda c: otel.estimate_log_bytes(c, c), ["é", "abc", None]) == [260, 262, 256]
