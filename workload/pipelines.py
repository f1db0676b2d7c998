"""Registered queries that write something on the way: landing folders, streams and outbound bodies."""

from pyspark.sql import functions as F

from telemere.operators import paging, search, stats
from telemere.plans import readers
from telemere.plans.catalog import attach
from telemere.plans.landing import Landing, land_pages, materialise, write_bodies
from telemere.plans.options import Provider
from telemere.session import shared_dir
from telemere.sinks.logs import intake_fields, intake_json, log_batches
from telemere.sinks.spans import agent_spans, trace_batches, trace_groups
from telemere.sources import intake
from telemere.streaming import intake as stream
from telemere.streaming import rolling
from workload import fixtures as fx
from workload import relations_sql as R
from workload.queries import logs, query, spans, with_logs

# --- flagship ------------------------------------------------------------------------------------


@query(
    "errors_per_service",
    with_logs(
        """SELECT '{"service":"' || service_name || '"}' AS "by", CAST(count(*) AS DOUBLE) AS value FROM logs
           WHERE severity_text = 'error' AND service_name IS NOT NULL
             AND time_unix_nano >= 1704067200000000000 AND time_unix_nano < 1706572800000000000
           GROUP BY service_name ORDER BY value DESC, service_name LIMIT 5"""
    ),
)
def _(spark, sf):
    found = search.where_all(logs(spark, sf), search.predicates({"status": "error"}))
    bounded = search.where_time(found, 1704067200000000000, 1706572800000000000)
    return stats.log_stats(bounded, group_by=["service"], group_limit=5)


# --- landing folders and attachments -------------------------------------------------------------


@query(
    "index_scoped_read",
    with_logs(f"SELECT {R.LOG_COLUMNS} FROM logs WHERE idx = 'audit' AND team = 't1'"),
)
def _(spark, sf):
    path = shared_dir(spark, "landing")
    land_pages(fx.catalog_log_pages(spark, sf), f"{path}/logs", ["index"])
    return readers.read_logs(
        spark, Landing(path), {"team": "t1"}, from_="2024-01-01T00:00:00Z", to="1709251200000", indexes=["audit"]
    )


@query(
    "attached_views",
    f"""WITH {R.LOGS}, {R.SPANS}, {R.METRICS}, {R.ALERTS}, {R.DEPENDENCIES}
        SELECT 'logs.main' AS name, count(*) AS n FROM logs WHERE idx = 'main'
          AND time_unix_nano >= 1705999100000000000 AND time_unix_nano < 1706000000000000000
        UNION ALL SELECT 'logs.audit', count(*) FROM logs WHERE idx = 'audit'
          AND time_unix_nano >= 1705999100000000000 AND time_unix_nano < 1706000000000000000
        UNION ALL SELECT 'traces.spans', count(*) FROM spans
          WHERE start_time_unix_nano >= 1705999100000000000 AND start_time_unix_nano < 1706000000000000000
        UNION ALL SELECT 'metrics.series', count(*) FROM metrics
          WHERE time_unix_nano BETWEEN 1704067200000000000 AND 1706000000000000000
        UNION ALL SELECT 'alerts.open', count(*) FROM (
          WITH heads AS (
            SELECT scan_id, page_no, count(*) AS n,
              CASE scan_id WHEN 'click' THEN 120 WHEN 'error' THEN 50 END AS total FROM alert_groups GROUP BY 1, 2),
          run AS (SELECT *, sum(n) OVER (PARTITION BY scan_id ORDER BY page_no) AS seen FROM heads),
          ends AS (SELECT scan_id, min(page_no) AS last FROM run
            WHERE n = 0 OR seen >= total OR (total IS NULL AND n < 100) GROUP BY 1)
          SELECT 1 FROM alert_groups LEFT JOIN ends USING (scan_id)
          WHERE (last IS NULL OR page_no <= last) AND status IN ('Alert', 'Warn', 'No Data'))
        UNION ALL SELECT 'service_map.dependencies', count(*) FROM edges_api""",
)
def _(spark, sf):
    path = fx.land(spark, sf, shared_dir(spark, "landing"))
    attached = attach(
        spark,
        "ops",
        path,
        Provider("acme", "acme.example"),
        now=1706000000,
        INDEXES=["main", "audit", "main"],
        SERVICE_MAP_ENV="prod",
        SERVICE_MAP_START_TIME="1704067200",
        SERVICE_MAP_END_TIME="1706659200",
        METRICS_QUERY="sum:events.value{*} by {type}",
        METRICS_START_TIME="1704067200",
    )
    counts = [
        f"SELECT '{table}' AS name, count(*) AS n FROM {attached.view_name(table)}" for table in attached.tables
    ]
    return spark.sql(" UNION ALL ".join(counts))


@query(
    "exported_window",
    with_logs(
        """SELECT idx AS "index", severity_text, count(*) AS n, count(DISTINCT trace_id) AS traces FROM logs
           WHERE idx = 'main' AND time_unix_nano >= 1704844800000000000 AND time_unix_nano < 1705500000000000000
           GROUP BY ALL"""
    ),
)
def _(spark, sf):
    path = shared_dir(spark, "export")
    pages = fx.indexed_log_pages(spark, sf)
    from telemere.sources.logs import normalise_logs

    materialise(normalise_logs(pages, carry=("index",)), path)
    exported = search.where_index(spark.read.parquet(path), ["main"])
    window = search.where_time(exported, 1704844800000000000, 1705500000000000000)
    return window.groupBy("index", "severity_text").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trace_id").alias("traces")
    )


# --- outbound logs -------------------------------------------------------------------------------


@query(
    "intake_fields",
    with_logs(
        """SELECT body AS message, service_name AS service, severity_text AS status, CAST(NULL AS VARCHAR) AS hostname,
             'spark' AS ddsource, CAST(NULL AS VARCHAR) AS ddtags, trace_id, span_id, log_attributes,
             resource_attributes, time_unix_nano // 1000000 AS "timestamp" FROM logs"""
    ),
)
def _(spark, sf):
    return intake_fields(logs(spark, sf))


_ITEM = """'{' || concat_ws(',', '"message":"' || body || '"', '"service":"' || service_name || '"',
  '"status":"' || severity_text || '"', '"ddsource":"spark"', '"timestamp":' || time_unix_nano // 1000000,
  '"trace_id":"' || trace_id || '"', '"span_id":"' || span_id || '"',
  '"hostname":"' || host || '"', '"ddtags":"env:' || env || ',team:' || team || '"',
  '"resource_attributes":' || resource_attributes,
  '"k":' || k, '"duration_ns":' || duration_ns,
  '"http":{"method":"GET","status_code":' || CASE WHEN event_type = 'error' THEN 500 ELSE 200 END || '}') || '}'"""


@query(
    "intake_payload",
    with_logs(
        f"""SELECT {_ITEM} AS item, CAST(256 + strlen(body) + coalesce(strlen(service_name), 0)
              + strlen(severity_text) + 5 + coalesce(strlen(trace_id), 0) + coalesce(strlen(span_id), 0)
              + strlen(log_attributes) + coalesce(strlen(resource_attributes), 0) AS BIGINT) AS n_bytes FROM logs"""
    ),
)
def _(spark, sf):
    return intake_json(intake_fields(logs(spark, sf)))


@query(
    "batch_packing",
    """SELECT count(*) AS n_rows, CAST(sum(256 + strlen(text) + coalesce(strlen(source), 0)
         + coalesce(strlen(lang), 0)) AS BIGINT) AS n_bytes, true AS within_limits FROM documents""",
)
def _(spark, sf):
    documents = fx.table(spark, sf, "documents").selectExpr(
        "text as body", "source as ddsource", "lang as service", "doc_id as ignored"
    )
    batches = log_batches(documents, max_rows=200, max_bytes=262_144)
    fits = (F.col("n_rows") <= 200) & ((F.col("n_bytes") <= 262_144) | (F.col("n_rows") == 1))
    return batches.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
        F.bool_and(fits).alias("within_limits"),
    )


@query(
    "batched_bodies",
    """SELECT text AS message, lang AS service, coalesce(nullif(source, ''), 'spark') AS ddsource FROM documents""",
)
def _(spark, sf):
    documents = fx.table(spark, sf, "documents").selectExpr(
        "text as body", "source as ddsource", "lang as service"
    )
    items = F.explode(F.from_json("body", "array<struct<message:string,service:string,ddsource:string>>"))
    return log_batches(documents, max_rows=100, max_bytes=100_000).select(items.alias("log")).select("log.*")


def _run_intake(spark, requests, **options):
    root = shared_dir(spark, "intake")
    write_bodies(requests, f"{root}/requests")
    settings = stream.IntakeOptions(
        source=f"{root}/requests",
        table=f"{root}/table",
        rejects=f"{root}/rejects",
        checkpoint=f"{root}/checkpoint",
        max_files_per_trigger=4,
        **options,
    )
    stream.run_available(spark, root.rsplit("-", 1)[1], settings)
    return spark.read.parquet(f"{root}/table"), spark.read.schema(intake.REJECTS).parquet(f"{root}/rejects")


@query(
    "round_trip",
    with_logs(
        f"""SELECT time_unix_nano // 1000000 * 1000000 AS time_unix_nano,
             1706745600000000000 AS observed_time_unix_nano, trace_id, span_id, service_name, service_namespace,
             service_instance_id, severity_number, severity_text, event_name, body,
             '{{' || concat_ws(',', '"host":"' || host || '"', '"ddsource":"spark"',
               '"ddtags":["env:' || env || '","team:' || team || '"]') || '}}' AS resource_attributes,
             scope_name, scope_version, scope_attributes,
             '{{' || concat_ws(',', '"trace_id":"' || trace_id || '"', '"span_id":"' || span_id || '"',
               '"resource_attributes":{{' || nullif(concat_ws(',', '"ddtags":["env:' || env || '","team:' || team || '"]',
                 '"host":"' || host || '"'), '') || '}}',
               '"k":' || k, '"duration_ns":' || duration_ns,
               '"http":{{"method":"GET","status_code":' || CASE WHEN event_type = 'error' THEN 500 ELSE 200 END || '}}')
               || '}}' AS log_attributes, dropped_attributes_count, flags FROM logs"""
    ),
)
def _(spark, sf):
    sent = log_batches(logs(spark, sf)).select(
        F.col("batch_id").alias("request_id"),
        F.lit(1706745600000000000).alias("received_unix_nano"),
        F.lit("application/json").alias("content_type"),
        F.lit("").alias("api_key"),
        "body",
    )
    received, _ = _run_intake(spark, sent)
    return received


# --- outbound spans ------------------------------------------------------------------------------

_DEFECTS = f"""
sent AS (
  SELECT *,
    CASE WHEN span_no % 11 = 0 THEN NULL WHEN order_key % 3 = 0 THEN '00ab' || substr(trace_id, 5) ELSE trace_id END AS tid,
    CASE WHEN span_no % 13 = 0 THEN 'xyz' ELSE span_id END AS sid,
    CASE WHEN span_no % 17 <> 0 THEN start_time_unix_nano END AS st,
    CASE WHEN span_no % 19 = 0 THEN -5 ELSE duration_time_unix_nano END AS du,
    CASE WHEN span_no % 23 <> 0 THEN service_name END AS svc,
    CASE WHEN span_no % 29 <> 0 THEN name END AS nm,
    CASE WHEN span_no % 31 = 0 THEN '{{not json' ELSE resource_attributes END AS res
  FROM spans),
outcomes AS (
  SELECT *, CASE WHEN tid IS NULL THEN 'skipped: missing or invalid trace_id'
    WHEN sid = 'xyz' THEN 'skipped: missing or invalid span_id'
    WHEN st IS NULL THEN 'skipped: missing or invalid start_time_unix_nano' ELSE 'ok' END AS outcome
  FROM sent)"""


def _defective_spans(spark, sf):
    return _defective(spans(spark, sf))


def _defective(rows):
    number = "cast(conv(span_id, 16, 10) as bigint)"
    order = f"{number} div 8"
    return rows.selectExpr(
        f"""case when {number} % 11 = 0 then null when ({order}) % 3 = 0 then concat('00ab', substr(trace_id, 5))
            else trace_id end as trace_id""",
        f"if({number} % 13 = 0, 'xyz', span_id) as span_id",
        "parent_span_id",
        f"if({number} % 17 = 0, null, start_time_unix_nano) as start_time_unix_nano",
        f"if({number} % 19 = 0, -5, duration_time_unix_nano) as duration_time_unix_nano",
        f"if({number} % 23 = 0, null, service_name) as service_name",
        f"if({number} % 29 = 0, '', name) as name",
        "kind",
        "status_code",
        "status_status_message",
        f"if({number} % 31 = 0, '{{not json', resource_attributes) as resource_attributes",
        "span_attributes",
    )


@query(
    "send_outcomes",
    f"WITH {R.SPANS}, {_DEFECTS} SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome",
)
def _(spark, sf):
    return agent_spans(_defective_spans(spark, sf)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "span_agent_rows",
    f"""WITH {R.SPANS}, {_DEFECTS}
        SELECT CAST(order_key AS DECIMAL(20, 0)) AS trace_id,
          CASE WHEN order_key % 3 = 0 THEN 'ab000000000000' ELSE '' END AS trace_id_high,
          CAST(span_no AS DECIMAL(20, 0)) AS span_id,
          CASE WHEN parent_span_id IS NOT NULL AND order_key > 0 THEN CAST(order_key * 8 AS DECIMAL(20, 0)) END AS parent_id,
          coalesce(svc, 'unknown-service') AS service, coalesce(nm, 'unnamed_operation') AS name,
          coalesce(nm, 'unnamed_operation') AS resource, CASE WHEN kind = 2 THEN 'web' END AS type,
          st AS start, CASE WHEN du >= 0 THEN du ELSE 0 END AS duration,
          CAST(CASE WHEN status_code = 2 THEN 1 END AS INTEGER) AS error
        FROM outcomes WHERE outcome = 'ok'""",
)
def _(spark, sf):
    sound = agent_spans(_defective_spans(spark, sf)).where("outcome = 'ok'")
    return sound.drop("outcome", "meta", "metrics")


@query(
    "span_meta_metrics",
    f"""WITH {R.SPANS}, {_DEFECTS}
        SELECT CAST(span_no AS DECIMAL(20, 0)) AS span_id,
          CASE WHEN order_key % 3 = 0 THEN 'ab000000000000' END AS high,
          CASE kind WHEN 2 THEN 'server' WHEN 3 THEN 'client' WHEN 5 THEN 'consumer' END AS kind,
          status_status_message AS message,
          CASE WHEN status_status_message IS NOT NULL THEN '{{"message":"' || status_status_message || '"}}'
               WHEN contains(span_attributes, '"error":{{}}') THEN '{{}}' END AS error,
          CASE WHEN ln IS NOT NULL THEN 'false' END AS single_span,
          CASE WHEN span_no % 31 = 0 THEN NULL WHEN ln IS NULL THEN '["env:prod","span.kind:SERVER"]'
               WHEN ln % 2 <> 0 THEN '["team:x","span.kind:consumer"]' END AS ddtags,
          CASE WHEN ln IS NOT NULL THEN CAST(duration_time_unix_nano AS DOUBLE) END AS duration,
          CASE WHEN ln IS NULL THEN 0 ELSE 1 END AS n_metrics
        FROM outcomes WHERE outcome = 'ok'""",
)
def _(spark, sf):
    sound = agent_spans(_defective_spans(spark, sf)).where("outcome = 'ok'")
    meta = {
        "high": "_dd.p.tid",
        "kind": "span.kind",
        "message": "error.message",
        "error": "error",
        "single_span": "single_span",
        "ddtags": "ddtags",
    }
    return sound.select(
        "span_id",
        *[F.try_element_at("meta", F.lit(key)).alias(name) for name, key in meta.items()],
        F.try_element_at("metrics", F.lit("duration")).alias("duration"),
        F.size("metrics").alias("n_metrics"),
    )


@query(
    "trace_groups",
    f"""WITH {R.SPANS}, {_DEFECTS}
        SELECT CAST(order_key AS DECIMAL(20, 0)) AS trace_id,
          CASE WHEN order_key % 3 = 0 THEN 'ab000000000000' ELSE '' END AS trace_id_high,
          count(*) AS n_spans, min(st) AS start,
          string_agg(CAST(span_no AS VARCHAR), ',' ORDER BY st, span_no) AS span_ids
        FROM outcomes WHERE outcome = 'ok' GROUP BY 1, 2""",
)
def _(spark, sf):
    groups = trace_groups(agent_spans(_defective_spans(spark, sf)))
    ids = F.from_json("body", "array<struct<span_id:string>>")["span_id"]
    return groups.select("trace_id", "trace_id_high", "n_spans", "start", F.array_join(ids, ",").alias("span_ids"))


@query(
    "trace_payload_totals",
    f"""WITH {R.SPANS} SELECT count(DISTINCT trace_id) AS traces, count(*) AS spans FROM spans""",
)
def _(spark, sf):
    sizes = F.transform(F.from_json("body", "array<array<string>>"), lambda t: F.size(t))
    batches = trace_batches(spans(spark, sf)).select(
        "n_rows", F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b).alias("spans")
    )
    return batches.agg(F.sum("n_rows").alias("traces"), F.sum("spans").alias("spans"))


# --- streaming -----------------------------------------------------------------------------------


@query("stream_intake", f"WITH {R.INTAKE} SELECT {R.LOG_COLUMNS} FROM intake")
def _(spark, sf):
    requests = fx.intake_requests(spark, sf)
    return _run_intake(spark, requests, api_key=fx.API_KEY, max_body_bytes=fx.MAX_BODY_BYTES)[0]


@query("stream_rejects", f"WITH {R.INTAKE} {R.REJECTS}")
def _(spark, sf):
    requests = fx.intake_requests(spark, sf)
    return _run_intake(spark, requests, api_key=fx.API_KEY, max_body_bytes=fx.MAX_BODY_BYTES)[1]


@query(
    "compressed_intake",
    f"""WITH {R.INTAKE.replace("WHERE kind NOT IN (4, 5, 6, 8, 12, 13)", "")}
        SELECT CASE WHEN event_id % 5 <> 4 THEN time_unix_nano END AS time_unix_nano, trace_id, service_name,
          severity_number, body, resource_attributes, log_attributes FROM intake""",
)
def _(spark, sf):
    root = shared_dir(spark, "compressed")
    lines = fx.table(spark, sf, "events").selectExpr(f"{fx.INTAKE_OBJECT} as value")
    lines.write.option("maxRecordsPerFile", 2000).text(f"{root}/bodies", compression="gzip")
    files = spark.read.text(f"{root}/bodies", wholetext=True)
    rows = intake.normalise_intake(stream.body_requests(files, "text/plain"))
    dated = F.when(F.col("time_unix_nano") != F.col("observed_time_unix_nano"), F.col("time_unix_nano"))
    return rows.select(
        dated.alias("time_unix_nano"),
        "trace_id",
        "service_name",
        "severity_number",
        "body",
        "resource_attributes",
        "log_attributes",
    )


def _log_stream(spark, rows, root):
    rows.write.parquet(f"{root}/logs")
    return spark.readStream.schema(rows.schema).parquet(f"{root}/logs")


def _drain(rows, root, schema):
    running = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    running.awaitTermination()
    return rows.sparkSession.read.schema(schema).parquet(f"{root}/out")


@query(
    "stream_rolling",
    with_logs(
        """, bound AS (SELECT max(time_unix_nano) // 1000 - 64800000000 AS micros FROM logs)
           SELECT time_bucket(INTERVAL 1 HOUR, make_timestamp(time_unix_nano // 1000)) AS window_start,
             time_bucket(INTERVAL 1 HOUR, make_timestamp(time_unix_nano // 1000)) + INTERVAL 1 HOUR AS window_end,
             severity_text AS status, count(*) AS n, CAST(sum(duration_ns) AS DOUBLE) AS sum
           FROM logs, bound
           WHERE (time_unix_nano // 3600000000000 + 1) * 3600000000 <= micros GROUP BY 1, 2, 3"""
    ),
)
def _(spark, sf):
    root = shared_dir(spark, "rolling")
    source = _log_stream(spark, logs(spark, sf), root)
    rolled = rolling.rolling_stats(source, "1 hour", group_by=("status",), metric="@duration_ns")
    rolled = rolled.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "status",
        "n",
        "sum",
    )
    return _drain(rolled, root, rolled.schema)


@query(
    "sliding_windows",
    with_logs(
        """, ends AS (SELECT time_unix_nano // 1800000000000 AS half, env FROM logs),
           hits AS (SELECT half, env FROM ends UNION ALL SELECT half - 1, env FROM ends)
           SELECT make_timestamp(half * 1800000000) AS window_start, env, count(*) AS n FROM hits GROUP BY 1, 2"""
    ),
)
def _(spark, sf):
    rolled = rolling.rolling_stats(logs(spark, sf), "1 hour", "30 minutes", ("env",))
    return rolled.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "env", "n")


@query(
    "late_rows_dropped",
    with_logs("SELECT severity_text, count(*) AS n FROM logs WHERE event_id % 40 <= 18 GROUP BY severity_text"),
)
def _(spark, sf):
    number = F.regexp_extract("body", r"(\d+)$", 1).cast("long")
    delayed = logs(spark, sf).withColumn(
        "observed_time_unix_nano", F.col("time_unix_nano") + number % 40 * 3_600_000_000_000
    )
    return rolling.drop_old(delayed).groupBy("severity_text").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedupe", with_logs("SELECT time_unix_nano, service_name, body FROM logs"))
def _(spark, sf):
    root = shared_dir(spark, "dedupe")
    once = logs(spark, sf)
    again = once.withColumn("observed_time_unix_nano", F.col("observed_time_unix_nano") + 1)
    source = _log_stream(spark, once.unionByName(again), root)
    unique = rolling.drop_redelivered(source, "40 days").select("time_unix_nano", "service_name", "body")
    return _drain(unique, root, unique.schema)


@query("batch_dedupe", with_logs("SELECT time_unix_nano, service_name, body FROM logs"))
def _(spark, sf):
    once = logs(spark, sf)
    again = once.withColumn("observed_time_unix_nano", F.col("observed_time_unix_nano") + 1)
    return rolling.drop_redelivered(once.unionByName(again)).select("time_unix_nano", "service_name", "body")


@query(
    "large_cap",
    with_logs(
        """SELECT severity_text, count(*) AS n, sum(k) AS k FROM (
             SELECT * FROM logs ORDER BY time_unix_nano DESC LIMIT 7000) GROUP BY severity_text"""
    ),
)
def _(spark, sf):
    """The cut used for caps too large for a heap, forced here on any size."""
    rows = logs(spark, sf)
    capped = paging.cap_rows(rows, 7000, descending=True, tiebreak=("body",))
    k = F.get_json_object("log_attributes", "$.k").cast("long")
    return capped.groupBy("severity_text").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"))
