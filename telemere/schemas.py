"""Fixed output schemas of the telemetry relations.

Times are epoch nanoseconds in BIGINT columns: Spark timestamps stop at
microseconds, and the ``*_unix_nano`` names already say what the number is.
Use :func:`telemere.functions.time.event_time` where a real timestamp is needed
(event-time windows, watermarks).
"""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Column names, order and types of every relation.
LOGS = _struct(
    ("time_unix_nano", _L),
    ("observed_time_unix_nano", _L),
    ("trace_id", _S),
    ("span_id", _S),
    ("service_name", _S),
    ("service_namespace", _S),
    ("service_instance_id", _S),
    ("severity_number", _I),
    ("severity_text", _S),
    ("event_name", _S),
    ("body", _S),
    ("resource_attributes", _S),
    ("scope_name", _S),
    ("scope_version", _S),
    ("scope_attributes", _S),
    ("log_attributes", _S),
    ("dropped_attributes_count", _I),
    ("flags", _I),
)

SPANS = _struct(
    ("start_time_unix_nano", _L),
    ("duration_time_unix_nano", _L),
    ("trace_id", _S),
    ("span_id", _S),
    ("parent_span_id", _S),
    ("trace_state", _S),
    ("service_name", _S),
    ("service_namespace", _S),
    ("service_instance_id", _S),
    ("name", _S),
    ("kind", _I),
    ("status_code", _I),
    ("status_status_message", _S),
    ("resource_attributes", _S),
    ("scope_name", _S),
    ("scope_version", _S),
    ("scope_attributes", _S),
    ("span_attributes", _S),
    ("events_json", _S),
    ("links_json", _S),
    ("dropped_attributes_count", _I),
    ("dropped_events_count", _I),
    ("dropped_links_count", _I),
    ("flags", _I),
)

METRICS = _struct(
    ("time_unix_nano", _L),
    ("start_time_unix_nano", _L),
    ("name", _S),
    ("description", _S),
    ("unit", _S),
    ("int_value", _L),
    ("double_value", _D),
    ("service_name", _S),
    ("service_namespace", _S),
    ("service_instance_id", _S),
    ("resource_attributes", _S),
    ("scope_name", _S),
    ("scope_version", _S),
    ("scope_attributes", _S),
    ("metric_attributes", _S),
    ("flags", _I),
    ("exemplars_json", _S),
)

ALERTS = _struct(
    ("monitor_id", _L),
    ("monitor_name", _S),
    ("group_name", _S),
    ("group_tags", T.ArrayType(_S)),
    ("status", _S),
    ("last_triggered_at", T.TimestampNTZType()),
    ("last_nodata_at", T.TimestampNTZType()),
)

DEPENDENCIES = _struct(
    ("provider", _S),
    ("source_service", _S),
    ("target_service", _S),
    ("source_type", _S),
    ("target_type", _S),
    ("edge_type", _S),
    ("environment", _S),
    ("window_start", T.TimestampNTZType()),
    ("window_end", T.TimestampNTZType()),
    ("request_count", _L),
    ("error_count", _L),
    ("fault_count", _L),
    ("throttle_count", _L),
    ("total_response_time_seconds", _D),
    ("source_attributes", _S),
    ("target_attributes", _S),
    ("edge_attributes", _S),
)

LOG_STATS = _struct(("by", _S), ("value", _D))

INDEXES = _struct(("name", _S), ("position", _I))


def project(schema, columns):
    """Expressions for every column of ``schema``: given ones cast, the rest typed NULL."""
    from pyspark.sql import functions as F

    unknown = set(columns) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in schema: {sorted(unknown)}")
    return [
        (columns[f.name] if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def same_layout(actual, expected):
    """True when both schemas have the same names and types in the same order."""
    return [(f.name, f.dataType) for f in actual.fields] == [
        (f.name, f.dataType) for f in expected.fields
    ]
