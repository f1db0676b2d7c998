import collections
import json

import pytest
from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions.window import Window
from telemere.sources import aggregates, alerts, dependencies, metrics
from telemere.sources.logs import normalise_logs
from telemere.sources.spans import normalise_spans


def pages(spark, *bodies):
    rows = [("s", i, "", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "scan_id string, page_no long, cursor string, body string")


def log(**attributes):
    return {"attributes": attributes}


def only(df):
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()]


def test_log_rows_are_strict_about_types(spark):
    events = [
        log(timestamp=5, service=7, status="Odd", message=["x"], host=1, tags=[], attributes={"trace_id": 5}),
        log(timestamp="bad", tags="x", attributes=[1]),
        log(status=None, host="h", tags=["a", 1], attributes={}),
        5,
        "text",
        {},
    ]
    df = normalise_logs(pages(spark, {"data": events}))
    assert schemas.same_layout(df.schema, schemas.LOGS)
    assert only(df) == [
        {"severity_number": 0, "severity_text": "Odd", "log_attributes": '{"trace_id":5}'},
        {},
        {"resource_attributes": '{"host":"h","ddtags":["a",1]}', "log_attributes": "{}"},
        {},
        {},
        {},
    ]


def test_pages_without_events_and_broken_pages(spark):
    assert normalise_logs(pages(spark, {}, {"data": {}}, {"data": []}, [])).count() == 0
    broken = pages(spark, {"data": [log(service="a")]}, '{"data": [')
    with pytest.raises(Exception, match="not valid JSON"):
        normalise_logs(broken).count()
    assert normalise_logs(broken, on_malformed="skip").count() == 1
    with pytest.raises(Exception, match="not valid JSON"):
        normalise_logs(pages(spark, '{"data": []} x')).count()


def test_span_rules(spark):
    def span(custom=None, **attributes):
        return {"attributes": {**attributes, **({"custom": custom} if custom is not None else {})}}

    events = [
        span({"operation_name": "op", "duration": 12.9, "span": {"kind": "weird"}}, tags=["span.kind:server"]),
        span({"error": {"message": "m"}}, status="OK", resource_name="r", tags=["x", "span.kind:client"]),
        span({"error": True}, error=0),
        span({"error": True}, error="text", operation_name="o"),
        span({"type": "own"}, error={}, type="web", single_span=False, retained_by=None),
        span(start_timestamp="2024-01-01T00:00:01Z", end_timestamp="2024-01-01T00:00:00.5Z", error={"message": "e"}),
        {},
        {"attributes": None},
    ]
    df = normalise_spans(pages(spark, {"data": events}))
    assert schemas.same_layout(df.schema, schemas.SPANS)
    kept = ("name", "kind", "status_code", "status_status_message", "duration_time_unix_nano", "span_attributes")
    rows = only(df.select(*kept))
    assert rows[0] == {
        "name": "op",
        "status_code": 0,
        "duration_time_unix_nano": 12,
        "span_attributes": '{"operation_name":"op","duration":12.9,"span":{"kind":"weird"}}',
    }
    assert rows[1] == {
        "name": "r",
        "kind": 3,
        "status_code": 0,
        "status_status_message": "m",
        "span_attributes": '{"error":{"message":"m"},"resource_name":"r"}',
    }
    assert [r.get("status_code") for r in rows] == [0, 0, 0, 2, 0, 2, None, 0]
    assert rows[4]["span_attributes"] == '{"type":"own","single_span":false}'
    assert rows[5] == {"status_code": 2, "status_status_message": "e", "duration_time_unix_nano": -500_000_000}


def test_metric_points(spark):
    body = {
        "series": [
            {
                "metric": "m",
                "tag_set": ["service_namespace:n", "service:", "service:s", "service.instance.id:i", 5],
                "pointlist": [[1000, 1], [2000.5, None], [3000, 2.5]],
                "unit": [{"name": "second"}],
            }
        ],
    }
    df = metrics.normalise_metrics(pages(spark, body), "acme", "site", include_series=True)
    assert schemas.same_layout(df.schema, schemas.METRICS)
    rows = only(df)
    assert [(r["time_unix_nano"], r["double_value"]) for r in rows] == [(10**9, 1.0), (3 * 10**9, 2.5)]
    # The first service tag wins even though it is empty, so the column stays NULL.
    assert "service_name" not in rows[0]
    assert rows[0]["service_namespace"] == "n" and rows[0]["service_instance_id"] == "i"
    assert rows[0]["unit"] == "second" and rows[0]["resource_attributes"] == '{"acme.site":"site"}'
    assert json.loads(rows[0]["metric_attributes"])["series"]["metric"] == "m"


@pytest.mark.parametrize(
    "body",
    [
        "{",
        '{"series": []} x',
        {},
        {"series": {}},
        {"series": [{"pointlist": []}]},
        {"series": [{"metric": "", "pointlist": []}]},
        {"series": [{"metric": "m"}]},
        {"series": [{"metric": "m", "pointlist": [[1]]}]},
        {"series": [{"metric": "m", "pointlist": [["1", 2]]}]},
        {"series": [{"metric": "m", "pointlist": [[1, "2"]]}]},
    ],
)
def test_malformed_metric_responses_are_fatal_or_rejected_whole(spark, body):
    good = {"series": [{"metric": "m", "pointlist": [[1, 2]]}]}
    landed = pages(spark, good, body)
    with pytest.raises(Exception, match="metric response"):
        metrics.normalise_metrics(landed, "p", "s").count()
    assert metrics.normalise_metrics(landed, "p", "s", on_malformed="skip").count() == 1
    assert metrics.metric_rejects(landed, ("page_no",)).count() == 1


def test_alert_groups(spark):
    groups = [
        {"monitor_id": 1, "monitor_name": "", "group": "g", "group_tags": ["a"], "status": "Alert",
         "last_triggered_ts": 60, "last_nodata_ts": 0},
        {"monitor_id": None, "group_tags": None, "status": "Warn", "last_triggered_ts": None},
        {"group_tags": [], "status": "No Data"},
        {"status": "alert"},
        {"status": "OK"},
        {},
    ]
    df = alerts.normalise_alerts(pages(spark, {"groups": groups, "metadata": {"total_count": 6}}))
    assert schemas.same_layout(df.schema, schemas.ALERTS)
    rows = only(df)
    assert len(rows) == 3
    assert rows[0]["monitor_name"] == "" and rows[0]["group_tags"] == ["a"]
    assert str(rows[0]["last_triggered_at"]) == "1970-01-01 00:01:00" and "last_nodata_at" not in rows[0]
    assert "group_tags" not in rows[1] and rows[2]["group_tags"] == []


@pytest.mark.parametrize(
    "body",
    [
        "x",
        [],
        {"groups": 1},
        {"groups": [5]},
        {"groups": [{"monitor_id": "1"}]},
        {"groups": [{"monitor_id": 1.5}]},
        {"groups": [{"status": 1}]},
        {"groups": [{"group_tags": "a"}]},
        {"groups": [{"group_tags": ["a", None]}]},
        {"groups": [], "metadata": []},
        {"groups": [], "metadata": {"total_count": -1}},
        {"groups": [], "metadata": {"total_count": "1"}},
    ],
)
def test_malformed_alert_pages(spark, body):
    with pytest.raises(Exception, match="alert"):
        alerts.normalise_alerts(pages(spark, body)).count()
    assert alerts.alert_rejects(pages(spark, body, {"groups": []})).count() == 1


def test_dependency_edges(spark):
    body = {"web": {"calls": ["db", "auth", "db"], "x": 1}, "auth": {"calls": []}, "db": {"calls": ["db"]}}
    window = Window(0, 3600)
    df = dependencies.normalise_dependencies(pages(spark, body, body), "acme", "prod", window)
    assert schemas.same_layout(df.schema, schemas.DEPENDENCIES)
    pairs = {(r.source_service, r.target_service) for r in df.collect()}
    assert pairs == {("web", "db"), ("web", "auth"), ("db", "db")} and df.count() == 3
    ordered = dependencies.edges_of(pages(spark, body)).orderBy("service_pos", "call_pos")
    assert [(r.source_service, r.target_service) for r in ordered.collect()] == [
        ("web", "db"),
        ("web", "auth"),
        ("db", "db"),
    ]
    for bad in ("{", [], {"a": 1}, {"a": {}}, {"a": {"calls": "b"}}, {"a": {"calls": [1]}}):
        with pytest.raises(Exception, match="dependency response"):
            dependencies.edges_of(pages(spark, bad)).count()


def test_aggregation_responses(spark):
    body = {
        "data": {
            "buckets": [
                {"by": {"z": "1", "a": "2"}, "computes": {"c9": 3, "c0": 4}},
                {"computes": {"c0": None}},
                {"by": 5, "computes": {"c0": "text"}},
                {"by": {}},
            ]
        }
    }
    rows = [tuple(r) for r in aggregates.normalise_aggregates(pages(spark, body)).collect()]
    assert rows == [('{"z":"1","a":"2"}', 3.0), ("{}", None), ("{}", None), ("{}", None)]
    assert aggregates.normalise_aggregates(pages(spark, {}, {"data": {}}, {"data": {"buckets": 1}})).count() == 0
    for bad in ("x", {"data": {"buckets": [1]}}):
        with pytest.raises(Exception, match="aggregation response"):
            aggregates.normalise_aggregates(pages(spark, bad)).count()


def test_index_names(spark):
    names = [{"name": "main"}, {"name": "security-events"}, {"name": "main"}]
    df = aggregates.normalise_indexes(pages(spark, {"indexes": names})).orderBy("position")
    assert [r["name"] for r in df.collect()] == ["main", "security-events"]
    for bad in ("x", {}, {"indexes": [1]}, {"indexes": [{"name": None}]}, {"indexes": [{"name": ""}]}):
        with pytest.raises(Exception, match="index"):
            aggregates.normalise_indexes(pages(spark, bad)).count()


def test_unused_columns_are_not_computed(spark):
    plan = normalise_logs(pages(spark, {"data": []})).select("service_name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "$.attributes.attributes" not in text and "$.attributes.tags" not in text
    assert "PythonUDF" not in text and "Exchange" not in text
    assert plan.where(F.col("service_name") == "x").count() == 0


def test_a_page_that_is_no_json_does_not_end_its_chain(spark):
    from telemere.operators import paging

    good = '{"data": [{"id": "%s"}], "meta": {"page": {"after": "%s"}}}'
    rows = [("s", 0, "", good % ("a", "c1")), ("s", 1, "c1", "<html>busy</html>"), ("s", 2, "c2", good % ("b", "c3"))]
    rows += [("s", 3, "c3", '{"data": []}'), ("s", 4, "c4", good % ("late", "c5"))]
    pages = spark.createDataFrame(rows, "scan_id string, page_no long, cursor string, body string")
    kept = paging.assemble_cursor_pages(pages).select("page_no").collect()
    assert sorted(r.page_no for r in kept) == [0, 1, 2, 3]


def test_an_event_that_repeats_a_key_is_not_lost(spark):
    body = '{"data": [{"id": "x", "attributes": {"message": "m", "status": "error", "status": "error", "tags": []}}]}'
    pages = spark.createDataFrame([("s", 0, "", body)], "scan_id string, page_no long, cursor string, body string")
    (row,) = normalise_logs(pages).collect()
    assert row.body == "m" and row.severity_text == "error"


ODD_CUSTOM = (
    "null", '"{\\"a\\":1}"', "[1]", "5", "{}", '{"span":"x","a":1}', '{"span":null}', '{"span":{"kind":"client"}}', '{"span":{"kind":3}}',
    '{"span":{"kind":"client"},"span":{"kind":"server"}}', '{"type":null,"error":{"message":"m"}}', '{"duration":1.9}', '{"duration":"7"}',
    '{"duration":12345678901234567890}', '{"error":{}}', '{"error":false,"operation_name":5}',
)


def test_fields_of_custom_are_the_same_by_both_ways(spark):
    """One element that is no object has the page's elements parsed one by one; its fields are those of the quick way."""
    event = '{{"attributes":{{"type":"t","resource_name":"r","custom":{}}}}}'
    bodies = [(n, "{" + f'"data":[{event.format(c)}{more}]' + "}") for n, c in enumerate(ODD_CUSTOM) for more in ("", ",7")]
    rows = normalise_spans(spark.createDataFrame(bodies, "n int, body string"), ("n",)).where("span_attributes is not null")
    found = rows.select("n", "kind", "status_code", "duration_time_unix_nano", "name", "status_status_message", "span_attributes").collect()
    counted = collections.Counter(found)
    assert set(counted.values()) == {2} and len(counted) == len(ODD_CUSTOM)
    by = {r.n: r for r in found}
    assert (by[7].kind, by[8].kind, by[9].kind) == (3, None, 2)
    assert by[10].span_attributes == '{"type":null,"error":{"message":"m"},"resource_name":"r"}'
    assert (by[10].status_code, by[10].status_status_message, by[11].duration_time_unix_nano) == (2, "m", 1)


def test_fields_that_are_often_missing_are_not_looked_up_in_a_variant(spark):
    """A path that a VARIANT lacks costs more than all else that is done with a span."""
    frame = spark.createDataFrame([('{"data":[]}',)], "body string")
    plan = normalise_spans(frame).select("kind", "name", "span_attributes")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert "$.span.kind" not in above and "$.operation_name" not in above and "$.retained_by" not in above
