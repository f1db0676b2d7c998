"""Log rows of any relation as outbound intake requests."""

from pyspark.sql import functions as F

from telemere.functions import json as J
from telemere.functions.otel import estimate_log_bytes, severity_to_status
from telemere.sinks import fields
from telemere.sinks.packing import MAX_BATCH_BYTES, MAX_BATCH_ROWS, pack

# Accepted input column names, best first.
INPUT_NAMES = {
    "message": ("body", "message"),
    "service": ("service_name", "service"),
    "status": ("severity_text", "severity", "status"),
    "hostname": ("hostname", "host"),
    "ddsource": ("ddsource",),
    "ddtags": ("ddtags",),
    "trace_id": ("trace_id",),
    "span_id": ("span_id",),
    "log_attributes": ("log_attributes",),
    "resource_attributes": ("resource_attributes",),
}
# Order of the keys of an outbound log.
KEY_ORDER = (
    "message",
    "service",
    "status",
    "ddsource",
    "hostname",
    "ddtags",
    "timestamp",
    "trace_id",
    "span_id",
)


def intake_fields(logs, default_source="spark"):
    """Outbound fields of every log row; empty text is NULL, unknown columns are ignored."""
    picked = {name: fields.text(fields.pick(logs, *names)) for name, names in INPUT_NAMES.items()}
    number = fields.pick(logs, "severity_number")
    if number is not None:
        by_number = F.coalesce(severity_to_status(fields.whole(number)), F.lit(""))
        picked["status"] = F.when(picked["status"] == "", by_number).otherwise(picked["status"])
    picked["ddsource"] = F.coalesce(fields.present(picked["ddsource"]), F.lit(default_source))
    primary = fields.pick(logs, "time_unix_nano", "timestamp")
    in_nanos = primary is not None and primary.name.lower() == "time_unix_nano"
    observed = fields.pick(logs, "observed_time_unix_nano")
    time = F.coalesce(fields.epoch_ms(primary, in_nanos), fields.epoch_ms(observed, True))
    return logs.select(
        *[fields.present(column).alias(name) for name, column in picked.items()], time.alias("timestamp")
    )


def _taken_keys(mined):
    """Keys of an outbound log that its attributes may not use."""
    return F.array_compact(
        F.array(
            *[F.when(F.col(name).isNotNull(), F.lit(name)) for name in KEY_ORDER if name not in mined],
            *[
                F.when(F.coalesce(F.col(name), F.col(f"_mined.{name}")).isNotNull(), F.lit(name))
                for name in mined
            ],
            F.when(F.col("_resource").isNotNull(), F.lit("resource_attributes")),
        )
    )


def intake_json(prepared):
    """JSON object of every prepared log, as (``item``, ``n_bytes``).

    Own fields come first, then host and tags mined from the resource, then the
    whole resource, then attributes whose keys are still free, the first value of a key
    that is repeated. Attribute text that is not a JSON object is ignored.
    """
    own = F.to_json(F.struct(*[F.col(name) for name in KEY_ORDER]))
    resource = J.parse(F.col("resource_attributes"))
    resource = F.when(J.is_object(resource), resource)
    tags = fields.present(F.array_join(J.string_elements(J.array_at(resource, "$.ddtags")), ","))
    mined = {
        "hostname": F.when(F.col("hostname").isNull(), J.string_at(resource, "$.host")),
        "ddtags": F.when(F.col("ddtags").isNull(), tags),
    }
    prepared = prepared.select(
        "*",
        own.alias("_own"),
        F.struct(*[column.alias(name) for name, column in mined.items()]).alias("_mined"),
        F.when(resource.isNotNull(), F.get_json_object("resource_attributes", "$")).alias("_resource"),
    )
    prepared = prepared.withColumn("_taken", _taken_keys(mined)).withColumn(
        "_typed", J.first_of_repeated(J.typed_map(F.col("log_attributes")))
    )
    free = F.map_filter("_typed", lambda k, _: ~F.array_contains("_taken", k))
    item = J.object_of(
        J.members(F.col("_own")),
        J.members(F.to_json("_mined")),
        F.concat(F.lit('"resource_attributes":'), F.col("_resource")),
        J.members(F.to_json(free)),
    )
    texts = [F.col(name) for name in INPUT_NAMES]
    return prepared.select(item.alias("item"), estimate_log_bytes(*texts).alias("n_bytes"))


def log_batches(logs, default_source="spark", max_rows=MAX_BATCH_ROWS, max_bytes=MAX_BATCH_BYTES):
    """Request bodies for a log relation: ``batch_id``, ``body``, ``n_rows``, ``n_bytes``."""
    return pack(intake_json(intake_fields(logs, default_source)), max_rows, max_bytes)
