"""Registered queries over landing folders: chains cut at landing, overlapping reads, current alerts."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemere.operators import paging
from telemere.plans import file_index, readers
from telemere.plans.landing import Landing, land_alert_pages, land_pages
from telemere.plans.options import Provider
from telemere.session import shared_dir
from telemere.sources.alerts import normalise_alerts
from telemere.sources.logs import normalise_logs
from workload import fixtures as fx
from workload import relations_sql as R
from workload.pipelines import _run_intake
from workload.queries import ORACLES, _alert_text, query, with_logs, with_spans

DAY_MS = 86_400_000


@query("landed_chains", ORACLES["page_assembly_cursor"])
def _(spark, sf):
    path = shared_dir(spark, "chains")
    land_pages(fx.broken_chain_pages(spark, sf), path)
    pages = paging.assemble_cursor_pages(spark.read.parquet(path))
    return normalise_logs(pages).select("time_unix_nano", "body", "log_attributes")


@query("landed_alert_chains", ORACLES["page_assembly_offset"])
def _(spark, sf):
    path = shared_dir(spark, "chains")
    land_alert_pages(fx.alert_pages(spark, sf), path)
    return _alert_text(normalise_alerts(paging.assemble_offset_pages(spark.read.parquet(path)), open_only=False))


@query(
    "window_across_days",
    with_logs(
        f"""SELECT {R.LOG_COLUMNS} FROM logs
            WHERE time_unix_nano >= 1704931200000000000 AND time_unix_nano < 1705017600000000000"""
    ),
)
def _(spark, sf):
    """Pages of 100 events span days; the page's own times decide whether a window reads it."""
    path = shared_dir(spark, "landing")
    land_pages(fx.log_pages(spark, sf), f"{path}/logs", ["dt"])
    return readers.read_logs(spark, Landing(path), from_="2024-01-11T00:00:00Z", to="2024-01-12T00:00:00Z")


# Most events of a page, as the search API has it.
PAGE_ROWS = 1000


def overlapping_scans(rows, event):
    """Three pulls of timed events whose windows overlap, as pages of at most ``PAGE_ROWS`` events of an hour.

    ``rows`` have ``event_id``, ``ms`` and what the expression ``event`` renders an event from, which is done only once
    rows have been dealt out by their hour. The oldest pull takes two days at a time and has not yet seen every other
    event; the next one takes a day; the newest takes the second half of even days.
    """
    number, hour = "ms div 86400000", "ms div 3600000"
    pulls = [
        ("old", 10, "event_id % 2 = 0", f"{number} div 2 * 2", 0, 2 * DAY_MS),
        ("day", 20, "true", number, 0, DAY_MS),
        ("late", 30, f"{number} % 2 = 0 and {hour} % 24 >= 12", number, DAY_MS // 2, DAY_MS),
    ]
    taken = None
    for name, received, chosen, start, offset, end in pulls:
        part = rows.where(chosen).selectExpr(
            "*",
            f"{hour} as hour_no",
            f"concat('{name}-', {start}) as scan_id",
            f"{start} * {DAY_MS} + {offset} as from_ms",
            f"{start} * {DAY_MS} + {end} as to_ms",
            f"{received}L as received_unix_nano",
        )
        taken = part if taken is None else taken.unionByName(part)
    nth = F.row_number().over(W.partitionBy("scan_id", "hour_no").orderBy("event_id"))
    numbered = taken.withColumn("part", F.call_function("div", nth - 1, F.lit(PAGE_ROWS)))
    keys = ["scan_id", "from_ms", "to_ms", "received_unix_nano", "hour_no", "part"]
    pages = fx._bodies(numbered.selectExpr(*keys, "event_id", f"{event} as event"), *keys)
    # A page without events would end its scan.
    pages = pages.where("items <> ''").withColumn("page_no", F.expr("(hour_no - from_ms div 3600000) * 1000000 + part"))
    return pages.selectExpr(
        "scan_id", "from_ms", "to_ms", "received_unix_nano", "page_no",
        "if(page_no = 0, '', cast(page_no as string)) as cursor",
        """concat('{"data":[', items, '],"meta":{"page":{"after":"', page_no + 1, '"}}}') as body""",
    )


@query("overlapping_log_scans", with_logs(f"SELECT {R.LOG_COLUMNS} FROM logs"))
def _(spark, sf):
    events = fx.table(spark, sf, "events")
    times = events.selectExpr("event_id", "unix_millis(cast(ts as timestamp)) as ms")
    path = shared_dir(spark, "landing")
    land_pages(overlapping_scans(events.join(times, "event_id"), fx.LOG_EVENT), f"{path}/logs")
    return readers.read_logs(spark, Landing(path), from_="2000-01-01T00:00:00Z", to="2040-01-01T00:00:00Z")


@query("overlapping_span_scans", with_spans(f"SELECT {R.SPAN_COLUMNS} FROM spans"))
def _(spark, sf):
    path = shared_dir(spark, "landing")
    land_pages(overlapping_scans(fx.span_rows(spark, sf), fx.SPAN), f"{path}/spans")
    return readers.read_spans(spark, Landing(path), from_="1980-01-01T00:00:00Z", to="2040-01-01T00:00:00Z")


@query(
    "overlapping_metric_scans",
    f"""WITH {R.METRICS}
        SELECT time_unix_nano, service_name, double_value + CASE
            WHEN time_unix_nano // 86400000000000 % 2 = 0 AND time_unix_nano // 3600000000000 % 24 >= 12 THEN 30 ELSE 20 END AS value
        FROM metrics""",
)
def _(spark, sf):
    """Each pull adds its own number to the values, so the answer shows which pull gave a point."""
    hourly = (
        fx.table(spark, sf, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
        .selectExpr("event_type", "hour(hour) as h", "unix_millis(cast(hour as timestamp)) as ms", "cents")
    )
    rows = None
    for name, received, days, first, last in (("old", 10, 2, 0, 48), ("day", 20, 1, 0, 24), ("late", 30, 1, 12, 24)):
        start = f"ms div {DAY_MS} div {days} * {days}"
        inside = hourly.where(f"(ms div 3600000) - ({start}) * 24 between {first} and {last - 1}")
        if name == "late":
            inside = inside.where(f"ms div {DAY_MS} % 2 = 0")
        part = inside.selectExpr(
            f"concat('{name}-', {start}) as scan_id",
            f"{received}L as received_unix_nano",
            f"({start}) * 86400 + {first * 3600} as start_s",
            f"({start}) * 86400 + {last * 3600} - 1 as end_s",
            "event_type",
            f"concat('[', ms, ',', if(h % 7 = 0, 'null', cast(cents + {received} as string)), ']') as point",
        )
        rows = part if rows is None else rows.unionByName(part)
    keys = ["scan_id", "received_unix_nano", "start_s", "end_s"]
    series = rows.groupBy(*keys, "event_type").agg(F.array_join(F.collect_list("point"), ",").alias("points"))
    items = series.selectExpr(
        *keys, """concat('{"metric":"m","tag_set":["service:', event_type, '"],"pointlist":[', points, ']}') as item"""
    )
    responses = items.groupBy(*keys).agg(F.concat(F.lit('{"series":['), F.array_join(F.collect_list("item"), ","), F.lit("]}")).alias("body"))
    path = shared_dir(spark, "landing")
    responses.withColumn("query", F.lit("sum:m{*}")).write.parquet(f"{path}/metrics")
    points = readers.read_metrics(
        spark, Landing(path), "sum:m{*}", "0", "4000000000", provider=Provider("acme", "acme.example"), now=4_000_000_000
    )
    return points.select("time_unix_nano", "service_name", F.col("double_value").alias("value"))


@query(
    "current_alerts",
    """WITH days AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3),
       newest AS (SELECT *, length(event_type) AS monitor_id FROM days
         QUALIFY day = max(day) OVER (PARTITION BY event_type)),
       latest AS (SELECT * FROM newest
         QUALIFY row_number() OVER (PARTITION BY monitor_id, user_id ORDER BY day DESC, event_type DESC) = 1)
       SELECT CAST(monitor_id AS BIGINT) AS monitor_id, event_type AS monitor_name, 'user:' || user_id AS group_name,
         CASE (n + day(day)) % 3 WHEN 0 THEN 'Alert' ELSE 'Warn' END AS status
       FROM latest WHERE (n + day(day)) % 3 <> 1""",
)
def _(spark, sf):
    """A scan a day for each event type; only each type's newest one says what is triggered now."""
    groups = (
        fx.table(spark, sf, "events")
        .groupBy("event_type", "user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rendered = groups.selectExpr(
        "event_type as scope",
        "concat(day, '-', event_type) as scan_id",
        "unix_date(day) as received_unix_nano",
        "user_id as event_id",
        """concat('{"monitor_id":', length(event_type), ',"monitor_name":"', event_type, '","group":"user:', user_id, '","status":"',
          case (n + dayofmonth(day)) % 3 when 0 then 'Alert' when 1 then 'OK' else 'Warn' end, '"}') as event""",
    )
    pages = fx._bodies(rendered, "scope", "scan_id", "received_unix_nano").selectExpr(
        "scope", "scan_id", "cast(received_unix_nano as long) as received_unix_nano", "0L as page_no",
        """concat('{"groups":[', items, ']}') as body""",
    )
    path = shared_dir(spark, "landing")
    land_alert_pages(pages, f"{path}/alerts")
    found = readers.read_open_alerts(spark, Landing(path))
    return found.select("monitor_id", "monitor_name", "group_name", "status")


@query(
    "stream_both_tables",
    f"""WITH {R.INTAKE}, refused AS ({R.REJECTS})
        SELECT 'log' AS kind, body AS what, CAST(NULL AS INTEGER) AS code FROM intake
        UNION ALL SELECT 'reject', request_id, code FROM refused""",
)
def _(spark, sf):
    """Accepted logs and refused requests of one run of one streaming query."""
    requests = fx.intake_requests(spark, sf)
    logs, refused = _run_intake(spark, requests, api_key=fx.API_KEY, max_body_bytes=fx.MAX_BODY_BYTES)
    kept = logs.select(F.lit("log").alias("kind"), F.col("body").alias("what"), F.lit(None).cast("int").alias("code"))
    return kept.unionByName(refused.select(F.lit("reject").alias("kind"), F.col("request_id").alias("what"), "code"))


@query(
    "search_through_index",
    with_logs(
        """SELECT 'text' AS kind, time_unix_nano, body FROM logs WHERE contains(body, 'purchase event 77')
           UNION ALL SELECT 'trace', time_unix_nano, body FROM logs
             WHERE trace_id = format('{:032x}', 1998) AND contains(body, 'event')
           UNION ALL SELECT 'service', time_unix_nano, body FROM logs WHERE service_name = 'svc-3' AND contains(body, 'view')"""
    ),
)
def _(spark, sf):
    """Free text, a trace and a service, each read from the files that the index names for it."""
    landing = Landing(shared_dir(spark, "landing"))
    land_pages(fx.log_pages(spark, sf).repartitionByRange(8, "scan_id", "page_no"), f"{landing.path}/logs")
    file_index.index_landed(spark, landing, "logs")

    def found(kind, facets, text):
        rows = readers.read_logs(spark, landing, facets, text=text, from_="2020-01-01T00:00:00Z", to="2030-01-01T00:00:00Z")
        return rows.select(F.lit(kind).alias("kind"), "time_unix_nano", "body")

    traced = found("trace", {"trace_id": f"{1998:032x}"}, "event")
    return found("text", None, "purchase event 77").unionByName(traced).unionByName(found("service", {"service": "svc-3"}, "view"))
