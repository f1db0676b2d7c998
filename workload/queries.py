"""Registered queries: one per operator, each over whole driver tables, with its checking SQL."""

from pyspark.sql import functions as F

from telemere.functions import json as J
from telemere.functions import otel, time
from telemere.functions.window import TimeBounds, Window, intersect, search_window
from telemere.operators import correlate, paging, search, stats
from telemere.sources import aggregates, alerts, dependencies, intake, metrics
from telemere.sources.logs import normalise_logs
from telemere.sources.spans import normalise_spans
from workload import fixtures as fx
from workload import relations_sql as R

QUERIES = {}
ORACLES = {}

PROVIDER, SITE = "acme", "acme.example"
MONTH = Window(1704067200, 1706659200)


def query(name, oracle=None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


def with_logs(select):
    return f"WITH {R.LOGS} {select}"


def with_spans(select):
    return f"WITH {R.SPANS} {select}"


def logs(spark, sf):
    return normalise_logs(fx.log_pages(spark, sf))


def spans(spark, sf):
    return normalise_spans(fx.span_pages(spark, sf))


def metric_points(spark, sf):
    return metrics.normalise_metrics(fx.metric_responses(spark, sf), PROVIDER, SITE)


def api_edges(spark, sf):
    return dependencies.normalise_dependencies(fx.dependency_responses(spark, sf, 200), PROVIDER, "prod", MONTH)


# --- sources -------------------------------------------------------------------------------------


@query("logs_normalise", with_logs(f"SELECT {R.LOG_COLUMNS} FROM logs"))
def _(spark, sf):
    return logs(spark, sf)


@query("spans_normalise", with_spans(f"SELECT {R.SPAN_COLUMNS} FROM spans"))
def _(spark, sf):
    return spans(spark, sf)


@query("metric_points", f"WITH {R.METRICS} SELECT * FROM metrics")
def _(spark, sf):
    return metric_points(spark, sf)


def _alert_text(df):
    return df.withColumn("group_tags", F.to_json("group_tags"))


@query(
    "alerts_open",
    f"""WITH {R.ALERTS} SELECT {R.ALERT_COLUMNS} FROM alert_groups
        WHERE status IN ('Alert', 'Warn', 'No Data')""",
)
def _(spark, sf):
    return _alert_text(alerts.normalise_alerts(fx.alert_pages(spark, sf)))


@query("service_edges_api", f"WITH {R.DEPENDENCIES} SELECT * FROM edges_api")
def _(spark, sf):
    return api_edges(spark, sf)


@query(
    "service_edges_first_seen",
    """WITH pairs AS (SELECT DISTINCT n_regionkey, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
       SELECT CAST(n_regionkey AS VARCHAR) AS scan_id, n_name AS source_service, s_name AS target_service,
         CAST(dense_rank() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS INTEGER) AS service_pos,
         CAST(row_number() OVER (PARTITION BY n_regionkey, n_name ORDER BY s_name) - 1 AS INTEGER) AS call_pos
       FROM pairs""",
)
def _(spark, sf):
    return dependencies.edges_of(fx.dependency_responses(spark, sf), ("scan_id",))


@query(
    "log_stats_response",
    f"""WITH counts AS (
          SELECT CAST(ts AS DATE) AS day, user_id % 7 AS svc, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
        SELECT CAST(day AS VARCHAR) AS scan_id,
          '{{"service":"svc-' || svc || '","type":"' || event_type || '"}}' AS "by",
          CASE WHEN n % 5 <> 0 THEN CAST(n AS DOUBLE) END AS value FROM counts
        UNION ALL SELECT CAST(day AS VARCHAR), '{{}}', CAST(sum(n) AS DOUBLE) FROM counts GROUP BY day""",
)
def _(spark, sf):
    return aggregates.normalise_aggregates(fx.aggregate_responses(spark, sf), ("scan_id",))


@query(
    "index_list",
    """SELECT CAST(event_id // 1000 AS VARCHAR) AS scan_id, event_type || '-' || (user_id % 10) AS name,
         CAST(min(event_id % 1000) AS INTEGER) AS position FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    return aggregates.normalise_indexes(fx.index_responses(spark, sf), ("scan_id",))


def _assessed(spark, sf):
    return intake.assess(fx.intake_requests(spark, sf), fx.API_KEY, fx.MAX_BODY_BYTES)


@query("intake_normalise", f"WITH {R.INTAKE} SELECT {R.LOG_COLUMNS} FROM intake")
def _(spark, sf):
    return intake.accepted_logs(_assessed(spark, sf))


@query("intake_rejects", f"WITH {R.INTAKE} {R.REJECTS}")
def _(spark, sf):
    return intake.rejected_requests(_assessed(spark, sf))


# --- paging and bounded relations ----------------------------------------------------------------


@query(
    "page_assembly_cursor",
    # Which page ends a chain depends on how the fixture broke it; later pages must be absent.
    with_logs(
        """SELECT time_unix_nano, body, log_attributes FROM logs
           WHERE page <= CASE scan % 5 WHEN 1 THEN 6 WHEN 2 THEN 3 WHEN 3 THEN 7 WHEN 4 THEN 8 ELSE 9 END"""
    ),
)
def _(spark, sf):
    pages = paging.assemble_cursor_pages(fx.broken_chain_pages(spark, sf))
    return normalise_logs(pages).select("time_unix_nano", "body", "log_attributes")


@query(
    "page_assembly_offset",
    f"""WITH {R.ALERTS}, heads AS (
          SELECT scan_id, page_no, count(*) AS n,
            CASE scan_id WHEN 'click' THEN 120 WHEN 'error' THEN 50 END AS total FROM alert_groups GROUP BY 1, 2),
        run AS (SELECT *, sum(n) OVER (PARTITION BY scan_id ORDER BY page_no) AS seen FROM heads),
        ends AS (SELECT scan_id, min(page_no) AS last FROM run
          WHERE n = 0 OR seen >= total OR (total IS NULL AND n < 100) GROUP BY 1)
        SELECT {R.ALERT_COLUMNS} FROM alert_groups LEFT JOIN ends USING (scan_id)
        WHERE last IS NULL OR page_no <= last""",
)
def _(spark, sf):
    pages = paging.assemble_offset_pages(fx.alert_pages(spark, sf))
    return _alert_text(alerts.normalise_alerts(pages, open_only=False))


@query(
    "max_rows_then_filter",
    with_logs(
        """SELECT service_name, count(*) AS n FROM
           (SELECT * FROM logs ORDER BY time_unix_nano DESC, body LIMIT 5000)
           WHERE severity_text = 'error' GROUP BY service_name"""
    ),
)
def _(spark, sf):
    capped = paging.cap_rows(logs(spark, sf), 5000, descending=True, tiebreak=("body",))
    return capped.where("severity_text = 'error'").groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "range_split",
    """WITH span AS (SELECT min(epoch_us(ts) // 3600000000) AS lo, max(epoch_us(ts) // 3600000000) + 1 AS hi FROM events),
       w AS (SELECT unnest(range(0, CAST(ceil((hi - lo) / 7.0) AS BIGINT))) AS window_no, lo, hi FROM span)
       SELECT window_no, (lo + window_no * 7) AS "from", least(lo + (window_no + 1) * 7, hi) AS "to",
         count(event_id) AS n
       FROM w LEFT JOIN events ON (epoch_us(ts) // 3600000000 - lo) // 7 = window_no GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    hours = fx.table(spark, sf, "events").select(
        F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(3_600_000_000)).alias("hour")
    )
    low, high = hours.agg(F.min("hour"), F.max("hour") + 1).first()
    windows = paging.sub_windows(spark, low, high, 7)
    numbered = hours.select(F.call_function("div", F.col("hour") - low, F.lit(7)).alias("window_no"))
    counted = numbered.groupBy("window_no").agg(F.count(F.lit(1)).alias("n"))
    return windows.join(counted, "window_no", "left").select(
        "window_no", "from", "to", F.coalesce("n", F.lit(0)).alias("n")
    )


# --- filters -------------------------------------------------------------------------------------


@query(
    "facet_filter",
    with_logs(f"SELECT {R.LOG_COLUMNS} FROM logs WHERE service_name = 'svc-3' AND severity_text = 'error'"),
)
def _(spark, sf):
    return search.where_all(
        logs(spark, sf), search.predicates({"service": "svc-3", "status": "error"})
    )


@query(
    "time_bounds",
    with_logs(
        """SELECT time_unix_nano, body FROM logs
           WHERE time_unix_nano >= 1704800000123456789 AND time_unix_nano < 1705500000123456789"""
    ),
)
def _(spark, sf):
    bounded = search.where_time(logs(spark, sf), 1704800000123456789, 1705500000123456789)
    return bounded.select("time_unix_nano", "body")


@query(
    "window_intersection",
    with_logs(
        """SELECT severity_text, count(*) AS n FROM logs
           WHERE time_unix_nano >= 1704800000123000000 AND time_unix_nano < 1705500000124000000
           GROUP BY severity_text"""
    ),
)
def _(spark, sf):
    bounds = TimeBounds().tighten(">=", 1704800000123456789).tighten("<", 1705500000123456789)
    start, end, _ = intersect("1704067200000", "1706659200000", bounds)
    inside = search.where_window(logs(spark, sf), search_window(start, end))
    return inside.groupBy("severity_text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "search_terms",
    with_logs(
        """SELECT time_unix_nano, body FROM logs
           WHERE env = 'prod' AND host = 'h2' AND duration_ns >= 1500000000 AND duration_ns < 4000000000
             AND contains(body, 'view')"""
    ),
)
def _(spark, sf):
    tests = search.predicates(
        {"env": "prod", "host": "h2"}, {"@duration_ns": [(">=", "1.5s"), ("<", 4_000_000_000)]}, "view"
    )
    return search.where_all(logs(spark, sf), tests).select("time_unix_nano", "body")


@query(
    "query_combination",
    with_logs("SELECT env, count(*) AS n FROM logs WHERE env = 'prod' AND service_name = 'svc-1' GROUP BY env"),
)
def _(spark, sf):
    base = search.predicates({"env": "prod"})
    both = base + search.predicates({"service": "svc-1"}) + search.predicates({"service": "svc-1"})
    kept = search.where_all(logs(spark, sf), both)
    return kept.groupBy(search.facet("env").alias("env")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "environment_scope",
    with_spans(
        """SELECT name, count(*) AS n FROM spans
           WHERE json_extract_string(resource_attributes, '$.env') = 'prod' GROUP BY name"""
    ),
)
def _(spark, sf):
    scoped = search.where_all(spans(spark, sf), search.predicates({"env": "prod"}, relation="spans"))
    return scoped.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "json_predicate",
    with_logs(
        """SELECT service_name, count(*) AS n FROM logs
           WHERE json_extract_string(log_attributes, '$.http.status_code') = '500' GROUP BY service_name"""
    ),
)
def _(spark, sf):
    failed = logs(spark, sf).where(F.get_json_object("log_attributes", "$.http.status_code") == "500")
    return failed.groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))


# --- joins ---------------------------------------------------------------------------------------


@query("edges_from_spans", f"WITH {R.SPANS}, {R.SPAN_EDGES} SELECT * FROM edges_spans")
def _(spark, sf):
    edges = correlate.edges_from_spans(spans(spark, sf), PROVIDER, "prod")
    return edges.withColumn("total_response_time_seconds", F.round("total_response_time_seconds", 6))


_LOGS_AND_SPANS = f"WITH {R.LOGS}, {R.SPANS}"


@query(
    "logs_join_spans",
    f"""{_LOGS_AND_SPANS} SELECT l.time_unix_nano, l.body, l.trace_id, s.name AS span_name,
          s.service_name AS span_service, s.status_code AS span_status
        FROM logs l LEFT JOIN spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id""",
)
def _(spark, sf):
    joined = correlate.with_span(logs(spark, sf), spans(spark, sf))
    return joined.select("time_unix_nano", "body", "trace_id", "span_name", "span_service", "span_status")


@query(
    "logs_join_traces",
    f"""{_LOGS_AND_SPANS}, t AS (
          SELECT trace_id, count(*) AS span_count, count(*) FILTER (WHERE status_code = 2) AS span_errors,
            count(DISTINCT service_name) AS service_count, min(start_time_unix_nano) AS trace_start_unix_nano,
            max(start_time_unix_nano + coalesce(duration_time_unix_nano, 0)) AS trace_end_unix_nano
          FROM spans GROUP BY trace_id)
        SELECT l.time_unix_nano, l.body, t.span_count, t.span_errors, t.service_count, t.trace_start_unix_nano,
          t.trace_end_unix_nano FROM logs l LEFT JOIN t USING (trace_id)""",
)
def _(spark, sf):
    joined = correlate.with_trace(logs(spark, sf), spans(spark, sf))
    return joined.select(
        "time_unix_nano",
        "body",
        "span_count",
        "span_errors",
        "service_count",
        "trace_start_unix_nano",
        "trace_end_unix_nano",
    )


@query(
    "logs_with_spans",
    f"""{_LOGS_AND_SPANS} SELECT time_unix_nano, body FROM logs
        WHERE trace_id IN (SELECT trace_id FROM spans)""",
)
def _(spark, sf):
    return correlate.logs_with_spans(logs(spark, sf), spans(spark, sf)).select("time_unix_nano", "body")


@query(
    "logs_without_spans",
    f"""{_LOGS_AND_SPANS} SELECT time_unix_nano, body FROM logs l
        WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.trace_id = l.trace_id)""",
)
def _(spark, sf):
    return correlate.logs_without_spans(logs(spark, sf), spans(spark, sf)).select("time_unix_nano", "body")


# --- aggregations --------------------------------------------------------------------------------


def stats_query(name, oracle, digits=None, **arguments):
    def build(spark, sf):
        result = stats.log_stats(logs(spark, sf), **arguments)
        return result if digits is None else result.withColumn("value", F.round("value", digits))

    query(name, with_logs(oracle))(build)


_BY_SERVICE = """'{"service":"' || service_name || '"}' AS "by\""""

stats_query("stats_count_total", """SELECT '{}' AS "by", CAST(count(*) AS DOUBLE) AS value FROM logs""")
stats_query(
    "stats_count_by_service",
    f"""SELECT {_BY_SERVICE}, CAST(count(*) AS DOUBLE) AS value FROM logs WHERE service_name IS NOT NULL
        GROUP BY service_name ORDER BY value DESC, service_name LIMIT 5""",
    group_by=["service"],
    group_limit=5,
)
stats_query(
    "stats_cardinality",
    """SELECT '{}' AS "by", CAST(count(DISTINCT trace_id) AS DOUBLE) AS value FROM logs""",
    compute="CARDINALITY",
    metric="@trace_id",
)
stats_query(
    "stats_cardinality_by_host",
    """SELECT '{"host":"' || host || '"}' AS "by", CAST(count(DISTINCT user_k) AS DOUBLE) AS value FROM
       (SELECT host, CAST(k AS VARCHAR) AS user_k FROM logs WHERE host IS NOT NULL)
       GROUP BY host ORDER BY value DESC, host LIMIT 3""",
    compute="cardinality",
    metric="@k",
    group_by=["host"],
    group_limit=3,
)
for _name in ("sum", "avg", "min", "max"):
    stats_query(
        f"stats_{_name}",
        f"""SELECT {_BY_SERVICE}, round({_name}(CAST(duration_ns AS DOUBLE)), 3) AS value FROM logs
            WHERE service_name IS NOT NULL GROUP BY service_name ORDER BY value DESC, service_name LIMIT 10""",
        digits=3,
        compute=_name,
        metric="@duration_ns",
        group_by=["service"],
    )
for _name, _p in stats.PERCENTILES.items():
    stats_query(
        f"stats_{_name}",
        f"""SELECT {_BY_SERVICE}, round(quantile_cont(CAST(duration_ns AS DOUBLE), {_p}), 1) AS value FROM logs
            WHERE service_name IS NOT NULL GROUP BY service_name ORDER BY value DESC, service_name LIMIT 10""",
        digits=1,
        compute=_name,
        metric="@duration_ns",
        group_by=["service"],
    )
stats_query(
    "stats_percentile_total",
    """SELECT '{}' AS "by", round(quantile_cont(CAST(duration_ns AS DOUBLE), 0.95), 1) AS value FROM logs""",
    digits=1,
    compute="pc95",
    metric="@duration_ns",
)
stats_query(
    "stats_percentile_of_nothing",
    """SELECT '{}' AS "by", quantile_cont(CAST(NULL AS DOUBLE), 0.95) AS value FROM logs""",
    compute="pc95",
    metric="@no_such_attribute",
)
stats_query(
    "stats_group_limit_nested",
    """, counts AS (SELECT env, host, team, count(*) AS n FROM logs
         WHERE env IS NOT NULL AND host IS NOT NULL AND team IS NOT NULL GROUP BY ALL),
       top1 AS (SELECT host FROM counts GROUP BY host ORDER BY sum(n) DESC, host LIMIT 2),
       top2 AS (SELECT host, team FROM (
         SELECT host, team, row_number() OVER (PARTITION BY host ORDER BY sum(n) DESC, team) AS r
         FROM counts WHERE host IN (SELECT host FROM top1) GROUP BY host, team) WHERE r <= 2),
       top3 AS (SELECT * FROM (
         SELECT host, team, env, n, row_number() OVER (PARTITION BY host, team ORDER BY n DESC, env) AS r
         FROM counts SEMI JOIN top2 USING (host, team)) WHERE r <= 2)
       SELECT '{"host":"' || host || '","team":"' || team || '","env":"' || env || '"}' AS "by",
         CAST(n AS DOUBLE) AS value FROM top3""",
    group_by=["host", "team", "env"],
    group_limit=2,
)
stats_query(
    "stats_attribute_facet",
    """SELECT '{"@k":"' || k || '"}' AS "by", round(avg(CAST(duration_ns AS DOUBLE)), 3) AS value FROM logs
       GROUP BY k ORDER BY value DESC, CAST(k AS VARCHAR) LIMIT 10""",
    digits=3,
    compute="avg",
    metric="@duration_ns",
    group_by=["@k"],
)


@query(
    "stats_no_buckets",
    """SELECT '' AS "by", CAST(0 AS DOUBLE) AS value FROM events WHERE false""",
)
def _(spark, sf):
    return stats.log_stats(logs(spark, sf), group_by=["no_such_tag"])


@query(
    "metric_rollup",
    f"""WITH {R.METRICS} SELECT time_unix_nano // 21600000000000 * 21600000000000 AS time_unix_nano, name,
          service_name AS service, round(avg(double_value), 6) AS value FROM metrics GROUP BY ALL""",
)
def _(spark, sf):
    rolled = stats.metric_rollup(
        metric_points(spark, sf), "avg", "events.value", {"host": "h1"}, ("service",), 21_600
    )
    return rolled.withColumn("value", F.round("value", 6))


@query(
    "conditional_counts",
    with_logs(
        """SELECT service_name, count(*) FILTER (WHERE severity_number >= 17) AS errors,
             bool_and(severity_number > 0) AS all_known FROM logs GROUP BY service_name"""
    ),
)
def _(spark, sf):
    return logs(spark, sf).groupBy("service_name").agg(
        F.count_if(F.col("severity_number") >= 17).alias("errors"),
        F.bool_and(F.col("severity_number") > 0).alias("all_known"),
    )


# --- ordering, sets, latest state ----------------------------------------------------------------


@query(
    "alerts_latest_state",
    """WITH days AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY day DESC) AS r FROM days),
       states AS (SELECT CAST(day AS VARCHAR) AS day, event_type AS monitor_name, 'user:' || user_id AS group_name,
         CASE (n + day(day)) % 3 WHEN 0 THEN 'Alert' WHEN 1 THEN 'OK' ELSE 'Warn' END AS status
         FROM ranked WHERE r = 1)
       SELECT * FROM states WHERE status <> 'OK'""",
)
def _(spark, sf):
    history = alerts.normalise_alerts(fx.alert_history(spark, sf), ("scan_id",), open_only=False)
    # Monitors are told apart by name here: two of them share an id in these pages.
    keyed = history.withColumn("monitor_id", F.xxhash64("monitor_name"))
    latest = correlate.latest_state(keyed, observed="scan_id")
    return latest.select(F.col("scan_id").alias("day"), "monitor_name", "group_name", "status")


@query(
    "latest_n",
    with_logs("SELECT time_unix_nano, service_name, body FROM logs ORDER BY time_unix_nano DESC, body LIMIT 100"),
)
def _(spark, sf):
    newest = paging.cap_rows(logs(spark, sf), 100, descending=True, tiebreak=("body",))
    return newest.select("time_unix_nano", "service_name", "body")


@query(
    "first_n_ascending",
    with_logs("SELECT time_unix_nano, body FROM logs ORDER BY time_unix_nano, body LIMIT 250"),
)
def _(spark, sf):
    ordered = search.sorted_by(logs(spark, sf), "timestamp", tiebreak=("body",))
    return ordered.limit(250).select("time_unix_nano", "body")


@query(
    "alerts_by_recency",
    f"""WITH {R.ALERTS} SELECT monitor_name, group_name, last_nodata_at FROM alert_groups
        WHERE status IN ('Alert', 'Warn', 'No Data')
        ORDER BY last_nodata_at DESC NULLS LAST, monitor_name, group_name LIMIT 400""",
)
def _(spark, sf):
    open_alerts = alerts.normalise_alerts(fx.alert_pages(spark, sf))
    ordered = open_alerts.orderBy(F.desc_nulls_last("last_nodata_at"), "monitor_name", "group_name")
    return ordered.select("monitor_name", "group_name", "last_nodata_at").limit(400)


@query(
    "edges_union_by_name",
    f"""WITH {R.SPANS}, {R.SPAN_EDGES}, {R.DEPENDENCIES}
        SELECT * FROM edges_api UNION ALL BY NAME SELECT * FROM edges_spans""",
)
def _(spark, sf):
    computed = correlate.edges_from_spans(spans(spark, sf), PROVIDER, "prod").withColumn(
        "total_response_time_seconds", F.round("total_response_time_seconds", 6)
    )
    return correlate.union_edges(api_edges(spark, sf), computed.drop("fault_count", "edge_attributes"))


@query(
    "multi_index",
    with_logs("SELECT idx AS index, severity_text, count(*) AS n FROM logs GROUP BY ALL"),
)
def _(spark, sf):
    rows = normalise_logs(fx.indexed_log_pages(spark, sf), carry=("index",))
    chosen = search.where_index(rows, ["main", "audit"])
    return chosen.groupBy("index", "severity_text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "except_all",
    with_logs(
        """SELECT service_name, severity_text FROM logs
           EXCEPT ALL SELECT service_name, severity_text FROM logs WHERE idx = 'audit'"""
    ),
)
def _(spark, sf):
    columns = ("service_name", "severity_text")
    rows = normalise_logs(fx.indexed_log_pages(spark, sf), carry=("index",))
    return rows.select(*columns).exceptAll(search.where_index(rows, ["audit"]).select(*columns))


# --- scalar functions ----------------------------------------------------------------------------


@query(
    "severity_map",
    """SELECT s AS status, CASE WHEN lower(s) = 'trace' THEN 1 WHEN lower(s) = 'debug' THEN 5
         WHEN lower(s) IN ('info', 'notice', 'ok') THEN 9 WHEN lower(s) IN ('warn', 'warning') THEN 13
         WHEN lower(s) IN ('error', 'err') THEN 17
         WHEN lower(s) IN ('critical', 'crit', 'alert', 'emergency', 'fatal') THEN 21 ELSE 0 END AS severity,
         CASE WHEN n BETWEEN 1 AND 4 THEN 'trace' WHEN n BETWEEN 5 AND 8 THEN 'debug'
         WHEN n BETWEEN 9 AND 12 THEN 'info' WHEN n BETWEEN 13 AND 16 THEN 'warn'
         WHEN n BETWEEN 17 AND 20 THEN 'error' WHEN n BETWEEN 21 AND 24 THEN 'critical' ELSE '' END AS back,
         count(*) AS rows
       FROM (SELECT CAST(event_id % 27 AS INTEGER) AS n, CASE event_id % 16 WHEN 0 THEN 'Trace' WHEN 1 THEN 'DEBUG'
         WHEN 2 THEN 'info' WHEN 3 THEN 'Notice' WHEN 4 THEN 'ok' WHEN 5 THEN 'Warn' WHEN 6 THEN 'warning'
         WHEN 7 THEN 'ERROR' WHEN 8 THEN 'err' WHEN 9 THEN 'critical' WHEN 10 THEN 'Crit' WHEN 11 THEN 'alert'
         WHEN 12 THEN 'emergency' WHEN 13 THEN 'FATAL' ELSE event_type || '?' END AS s FROM events) GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    names = [
        "Trace", "DEBUG", "info", "Notice", "ok", "Warn", "warning", "ERROR", "err", "critical", "Crit", "alert",
        "emergency", "FATAL",
    ]
    spelled = F.coalesce(
        F.get(F.array(*map(F.lit, names)), (F.col("event_id") % 16).cast("int")),
        F.concat("event_type", F.lit("?")),
    )
    rows = fx.table(spark, sf, "events").select(
        spelled.alias("status"), (F.col("event_id") % 27).cast("int").alias("n")
    )
    mapped = rows.select(
        "status",
        otel.status_to_severity(F.col("status")).alias("severity"),
        otel.severity_to_status(F.col("n")).alias("back"),
    )
    return mapped.groupBy("status", "severity", "back").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "span_kind_map",
    """SELECT k AS kind, CASE regexp_replace(lower(k), '^span_kind_', '') WHEN 'internal' THEN 1 WHEN 'server' THEN 2
         WHEN 'client' THEN 3 WHEN 'producer' THEN 4 WHEN 'consumer' THEN 5 ELSE 0 END AS number,
         CASE n WHEN 1 THEN 'internal' WHEN 2 THEN 'server' WHEN 3 THEN 'client' WHEN 4 THEN 'producer'
         WHEN 5 THEN 'consumer' END AS back, count(*) AS rows
       FROM (SELECT o_orderkey % 8 AS n, CASE o_orderkey % 6 WHEN 0 THEN 'SPAN_KIND_SERVER' WHEN 1 THEN 'client'
         WHEN 2 THEN 'Producer' WHEN 3 THEN 'span_kind_consumer' WHEN 4 THEN 'INTERNAL' ELSE o_orderpriority END AS k
         FROM orders) GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey % 8 as n",
        """case o_orderkey % 6 when 0 then 'SPAN_KIND_SERVER' when 1 then 'client' when 2 then 'Producer'
           when 3 then 'span_kind_consumer' when 4 then 'INTERNAL' else o_orderpriority end as kind""",
    )
    mapped = rows.select(
        "kind", otel.kind_to_int(F.col("kind")).alias("number"), otel.int_to_kind(F.col("n")).alias("back")
    )
    return mapped.groupBy("kind", "number", "back").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "iso_to_nanos",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(ts) * 1000 + event_id % 1000
         WHEN 1 THEN epoch_us(ts) * 1000 - 19800000000000
         WHEN 2 THEN epoch_us(date_trunc('second', ts)) * 1000
         WHEN 3 THEN epoch_us(date_trunc('day', ts)) * 1000 WHEN 4 THEN epoch_us(ts) // 1000 * 1000000 END AS nanos
       FROM events""",
)
def _(spark, sf):
    text = """case event_id % 6
        when 0 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), lpad(event_id % 1000, 3, '0'), 'Z')
        when 1 then concat(date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), '+05:30')
        when 2 then date_format(ts, "yyyy-MM-dd HH:mm:ss") when 3 then date_format(ts, "yyyy-MM-dd")
        when 4 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS") else date_format(ts, "HH:mm") end"""
    rows = fx.table(spark, sf, "events").selectExpr("event_id", f"{text} as text")
    return rows.select("event_id", time.iso_to_nanos(F.col("text")).alias("nanos"))


_HEX = """CASE o_orderkey % 5 WHEN 0 THEN '0x' || format('{:x}', o_orderkey)
  WHEN 1 THEN format('{:x}', o_custkey + 1) || format('{:016x}', o_orderkey)
  WHEN 2 THEN upper(format('{:032x}', o_orderkey)) WHEN 3 THEN o_orderpriority ELSE repeat('f', 33) END"""


@query(
    "hex_ids",
    """SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % 5 < 3 THEN CAST(o_orderkey AS DECIMAL(20, 0)) END AS low,
         CASE WHEN o_orderkey % 5 = 1 THEN format('{:x}', o_custkey + 1) WHEN o_orderkey % 5 < 3 THEN '' END AS high
       FROM orders""",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_key",
        """case o_orderkey % 5 when 0 then concat(' 0x', hex(o_orderkey), ' ')
           when 1 then concat(lower(hex(o_custkey + 1)), lpad(lower(hex(o_orderkey)), 16, '0'))
           when 2 then lpad(hex(o_orderkey), 32, '0') when 3 then o_orderpriority else repeat('f', 33) end as id""",
    )
    digits = otel.hex_digits(F.col("id"))
    return rows.select("order_key", otel.hex_low(digits).alias("low"), otel.hex_high(digits).alias("high"))


@query(
    "floor_ceil_ms",
    """SELECT event_id, n // 1000000 - CASE WHEN n % 1000000 < 0 THEN 1 ELSE 0 END AS floor_ms,
         n // 1000000 + CASE WHEN n % 1000000 > 0 THEN 1 ELSE 0 END AS ceil_ms
       FROM (SELECT event_id, (epoch_us(ts) * 1000 + event_id % 1000) * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END
             AS n FROM events)""",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "events").selectExpr(
        "event_id",
        """(unix_micros(cast(ts as timestamp)) * 1000 + event_id % 1000) * if(event_id % 2 = 0, 1, -1) as n""",
    )
    return rows.select(
        "event_id", time.floor_ms(F.col("n")).alias("floor_ms"), time.ceil_ms(F.col("n")).alias("ceil_ms")
    )


@query(
    "tag_values",
    with_logs("""SELECT team, env, count(*) AS n FROM logs GROUP BY team, env"""),
)
def _(spark, sf):
    tags = F.from_json(F.get_json_object("resource_attributes", "$.ddtags"), "array<string>")
    read = logs(spark, sf).select(
        otel.tag_value(tags, "squad", "team").alias("team"), otel.tag_value(tags, "env").alias("env")
    )
    return read.groupBy("team", "env").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_tags",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a:' || event_type || '|b:' || (user_id % 3)
         ELSE '' END AS tags FROM events""",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "events").selectExpr(
        "event_id",
        "if(event_id % 2 = 0, concat(' a:', event_type, ' ,,b:', user_id % 3, ','), ' , ') as text",
    )
    return rows.select("event_id", F.array_join(otel.split_tags(F.col("text")), "|").alias("tags"))


@query(
    "merge_first_wins",
    """SELECT event_id, '{"k":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || ',"type":"' || event_type || '","n":' ||
         event_id || '}' AS merged FROM events""",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "events").selectExpr(
        "event_id",
        "props",
        """concat('{"k":-1,"type":"', event_type, '"}') as second""",
        """concat('{"type":"x","n":', event_id, ',"k":null}') as third""",
    )
    maps = [J.typed_map(F.col(name)) for name in ("props", "second", "third")]
    return rows.select("event_id", F.to_json(J.merge_first_wins(*maps)).alias("merged"))


@query(
    "estimate_bytes",
    """SELECT doc_id, 256 + CAST(strlen(text) AS BIGINT) + coalesce(CAST(strlen(source) AS BIGINT), 0) AS n_bytes FROM documents""",
)
def _(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return docs.select("doc_id", otel.estimate_log_bytes(F.col("text"), F.col("source")).alias("n_bytes"))
