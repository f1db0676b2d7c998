"""Event-time aggregates, late-row handling and redelivery dedupe for log streams.

State is bounded by the watermark in every case; all functions also take batches.
"""

from pyspark.sql import functions as F

from telemere.functions.time import event_time
from telemere.operators.search import facet

# Fixed value: age after which the provider no longer indexes a log.
MAX_AGE = "18 hours"
MAX_AGE_NANOS = 18 * 3600 * 1_000_000_000

CONTENT = (
    "time_unix_nano",
    "trace_id",
    "span_id",
    "service_name",
    "severity_text",
    "body",
    "resource_attributes",
    "log_attributes",
)


def rolling_stats(logs, width="5 minutes", slide=None, group_by=(), metric=None, watermark=MAX_AGE):
    """Counts, and with ``metric`` sum, avg, min and max, per event-time window and facets.

    Windows tumble unless ``slide`` is given. Partial aggregation runs before the
    shuffle, so a facet value that dominates stays one row per task and window.
    """
    rows = logs.select(
        event_time(F.col("time_unix_nano")).alias("event_time"),
        *[facet(name).alias(name) for name in group_by],
        *([facet(metric).try_cast("double").alias("_metric")] if metric else []),
    ).withWatermark("event_time", watermark)
    window = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    measures = [F.count(F.lit(1)).alias("n")]
    if metric:
        measures += [
            F.sum("_metric").alias("sum"),
            F.avg("_metric").alias("avg"),
            F.min("_metric").alias("min"),
            F.max("_metric").alias("max"),
        ]
    grouped = rows.groupBy(window.alias("window"), *group_by).agg(*measures)
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*"
    ).drop("window")


def drop_old(logs, max_age_nanos=MAX_AGE_NANOS):
    """Logs not older than ``max_age_nanos`` when they were observed; those without a time have no age and stay."""
    age = F.col("observed_time_unix_nano") - F.col("time_unix_nano")
    return logs.where(age.isNull() | (age <= max_age_nanos))


def content_key():
    """Hash of what makes a log the same log, whenever it was received."""
    return F.sha2(F.to_json(F.struct(*CONTENT)), 256)


def drop_redelivered(logs, watermark=MAX_AGE):
    """Logs without repeats of the same content: within the watermark when streaming, else overall.

    Of a batch's repeats the one observed first stays.
    """
    keyed = logs.withColumn("_content", content_key())
    if not logs.isStreaming:
        first = F.min(F.struct("observed_time_unix_nano", *[c for c in logs.columns if c != "observed_time_unix_nano"]))
        return keyed.groupBy("_content").agg(first.alias("_log")).select("_log.*").select(*logs.columns)
    timed = keyed.withColumn("_event_time", event_time(F.col("time_unix_nano")))
    unique = timed.withWatermark("_event_time", watermark).dropDuplicatesWithinWatermark(["_content"])
    return unique.drop("_content", "_event_time")
