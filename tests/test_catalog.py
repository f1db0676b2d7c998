import json

import pytest

import telemere
from telemere import schemas
from telemere.operators import search
from telemere.plans.landing import Landing, land_pages, materialise
from telemere.plans.options import AttachOptions, NotConfigured, OptionError, Provider
from telemere.sources.logs import normalise_logs

NOW = 1704067200


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing"))

    def page(stamp, service):
        event = {"attributes": {"timestamp": stamp, "service": service, "status": "error", "message": service}}
        return json.dumps({"data": [event]})

    logs = [
        ("a", 0, "", page("2023-12-31T23:50:00Z", "web"), "main"),
        ("b", 0, "", page("2023-12-31T23:59:59Z", "db"), "audit"),
        ("c", 0, "", page("2023-12-30T00:00:00Z", "old"), "main"),
    ]
    land_pages(
        spark.createDataFrame(logs, "scan_id string, page_no long, cursor string, body string, `index` string"),
        f"{path}/logs",
        ["index"],
    )
    span = {"attributes": {"start_timestamp": "2023-12-31T23:55:00Z", "service": "web", "trace_id": "1"}}
    spans = [("a", 0, "", json.dumps({"data": [span]}))]
    land_pages(
        spark.createDataFrame(spans, "scan_id string, page_no long, cursor string, body string"), f"{path}/spans"
    )
    series = {"series": [{"metric": "m", "pointlist": [[(NOW - 60) * 1000, 1], [(NOW - 9000) * 1000, 2]]}]}
    spark.createDataFrame(
        [("avg:m{*}", NOW - 10_000, NOW, json.dumps(series))], "query string, start_s long, end_s long, body string"
    ).write.parquet(f"{path}/metrics")
    groups = {"groups": [{"status": "Alert"}, {"status": "OK"}]}
    spark.createDataFrame(
        [("a", 0, json.dumps(groups))], "scan_id string, page_no long, body string"
    ).write.parquet(f"{path}/alerts")
    spark.createDataFrame(
        [
            ("prod", None, NOW - 3600, NOW, '{"web":{"calls":["db"]}}'),
            ("prod", "region:x", NOW - 3600, NOW, '{"web":{"calls":["other"]}}'),
            ("dev", None, NOW - 3600, NOW, '{"web":{"calls":["dev"]}}'),
        ],
        "environment string, primary_tag string, start_s long, end_s long, body string",
    ).write.parquet(f"{path}/service_dependencies")
    spark.createDataFrame([('{"indexes":[{"name":"main"},{"name":"audit"},{"name":"main"}]}',)], "body string").write.parquet(
        f"{path}/indexes"
    )
    return path


def test_attachment_with_discovered_indexes(spark, landing):
    attached = telemere.attach(spark, "dd", landing, now=NOW)
    assert attached.tables == [
        "logs.main", "logs.audit", "alerts.open", "service_map.dependencies", "traces.spans", "metrics.series",
    ]
    assert [r.body for r in spark.table("dd_logs_main").collect()] == ["web"]
    assert [r.body for r in spark.table("dd_logs_audit").collect()] == ["db"]
    assert spark.table("dd_traces_spans").count() == 1 and spark.table("dd_alerts_open").count() == 1
    for table in attached.tables:
        assert schemas.same_layout(spark.table(attached.view_name(table)).schema, attached.schema(table))
    # Relative windows move with the clock when views are refreshed.
    attached.refresh(NOW + 3600)
    assert spark.table("dd_logs_main").count() == 0
    attached.detach()
    assert not spark.catalog.tableExists("dd_logs_main")


def test_unconfigured_tables_fail_only_when_scanned(spark, landing):
    attached = telemere.attach(spark, "lazy", landing, now=NOW, indexes=[])
    assert spark.table("lazy_service_map_dependencies").columns == schemas.DEPENDENCIES.fieldNames()
    for view in ("lazy_service_map_dependencies", "lazy_metrics_series"):
        with pytest.raises(Exception, match="not configured"):
            spark.table(view).count()
    with pytest.raises(NotConfigured):
        attached.table("metrics.series")


def test_configured_tables(spark, landing):
    attached = telemere.attach(
        spark, "conf", landing, Provider("acme", "acme.example"), now=NOW,
        Indexes=["main"], SERVICE_MAP_ENV="prod", metrics_query="avg:m{*}",
    )
    edge = spark.table("conf_service_map_dependencies").collect()
    assert [(e.provider, e.target_service, str(e.window_end)) for e in edge] == [("acme", "db", "2024-01-01 00:00:00")]
    assert [p.double_value for p in spark.table("conf_metrics_series").collect()] == [1.0]
    tagged = telemere.read_service_dependencies(spark, Landing(landing), "prod", primary_tag="region:x", now=NOW)
    assert [e.target_service for e in tagged.collect()] == ["other"]
    assert attached.tables[0] == "logs.main"


def test_reader_arguments(spark, landing):
    source = Landing(landing)
    rows = telemere.read_logs(spark, source, {"service": "web"}, from_="0", to="now", now_ms=NOW * 1000)
    assert rows.count() == 1
    newest = telemere.read_logs(spark, source, from_="0", to="now", sort="-timestamp", max_rows=1, now_ms=NOW * 1000)
    assert [r.body for r in newest.collect()] == ["db"]
    stats = telemere.read_log_stats(
        spark, source, {"status": "error"}, from_="0", to="now", group_by=["service"], now_ms=NOW * 1000
    )
    assert {r.by for r in stats.collect()} == {'{"service":"web"}', '{"service":"db"}', '{"service":"old"}'}
    for bad in (
        {"page_size": 0}, {"page_size": 1001}, {"max_rows": -1}, {"retries": -1}, {"timeout": 0}, {"sort": "newest"},
    ):
        with pytest.raises(OptionError):
            telemere.read_logs(spark, source, **bad)
    with pytest.raises(NotConfigured):
        telemere.read_metrics(spark, source, "  ")
    with pytest.raises(NotConfigured):
        telemere.read_service_dependencies(spark, source, "")


@pytest.mark.parametrize(
    "options",
    [
        {"unknown": 1},
        {"secret": ""},
        {"secret": None},
        {"indexes": "main"},
        {"indexes": ["a", ""]},
        {"indexes": ["a", None]},
        {"page_size": "5"},
        {"page_size": None},
        {"page_size": 0},
        {"max_rows": True},
        {"sort": "up"},
        {"service_map_env": ""},
        {"service_map_start_time": ""},
        {"metrics_query": ""},
        {"retries": -1},
        {"timeout": 0},
    ],
)
def test_attachment_options_are_checked(options):
    with pytest.raises(OptionError):
        AttachOptions.parse(options)


def test_attachment_defaults():
    assert AttachOptions.parse({"INDEXES": ["b", "a", "b"]}) == AttachOptions(indexes=("b", "a"))


def test_pruning_on_normalised_tables(spark, landing, tmp_path):
    pages = spark.read.parquet(f"{landing}/logs")
    materialise(normalise_logs(pages, carry=("index",)), f"{tmp_path}/logs")
    table = spark.read.parquet(f"{tmp_path}/logs")
    found = search.where_all(search.where_index(table, ["main"]), search.predicates({"service": "web"}))
    found = search.where_time(found, (NOW - 86400) * 10**9, NOW * 10**9).select("body")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(service_name,web)" in plan and "PushedFilters: [IsNotNull(service_name), IsNotNull(time_unix_nano)" in plan
    filters = plan[plan.index("PartitionFilters") :]
    assert "index#" in filters and "dt#" in filters
    assert "log_attributes" not in plan
    assert [r.body for r in found.collect()] == ["web"]


def test_index_reads_prune_partitions(spark, landing):
    rows = telemere.read_logs(spark, Landing(landing), indexes=["audit"], from_="0", to="now", now_ms=NOW * 1000)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "(index#" in plan[plan.index("PartitionFilters") :] and "PythonUDF" not in plan
    assert rows.count() == 1
