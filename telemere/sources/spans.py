"""Span search events as the 24-column span relation."""

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.functions.otel import known_kind
from telemere.functions.time import iso_to_nanos
from telemere.sources.pages import explode_attributes

# Per-span fields kept in span_attributes, in this order.
RESERVED_SPAN_FIELDS = ("resource_name", "type", "single_span", "ingestion_reason", "retained_by")
# Fixed value: tag that carries the span kind when the span itself does not, among joined tags.
KIND_TAG = "(?:^|\x00)span[.]kind:([^\x00]*)"
_JOINT = "\x00"


# Fields of an event's attributes that span columns are made of, and those of the object ``custom``.
FIELDS = dict.fromkeys(
    (
        "start_timestamp",
        "end_timestamp",
        "trace_id",
        "span_id",
        "parent_id",
        "service",
        "operation_name",
        "status",
        "error",
        "host",
        "env",
        "tags",
        *RESERVED_SPAN_FIELDS,
    )
) | {"custom": dict.fromkeys(("operation_name", "duration", "error", *RESERVED_SPAN_FIELDS)) | {"span": {"kind": None}}}


def _span_kind(custom, tags):
    own = J.as_string(custom["span"]["kind"])
    # One regular expression over the joined tags stays in generated code; a lambda would not.
    joined = F.array_join(F.try_variant_get(tags, "$", "array<string>"), _JOINT)
    return known_kind(F.coalesce(own, F.regexp_extract(joined, KIND_TAG, 1)))


def _error_flag(error):
    """What an ``error`` field says; NULL when it leaves the question open."""
    name = J.kind_of(error)
    said = (
        F.when(name == "BOOLEAN", F.try_variant_get(error, "$", "boolean"))
        .when(name.startswith("OBJECT"), F.nullif(name != "OBJECT<>", F.lit(False)))
        .when(J.is_number_kind(name), F.try_variant_get(error, "$", "double") != 0)
    )
    # Most spans have no such field, which is cheaper to see than to name its type.
    return F.when(error.isNotNull(), said)


def _status_code(of):
    status = J.as_string(of["status"])
    failed = F.when(status.isNotNull(), F.lower(status) == "error").otherwise(
        F.coalesce(
            _error_flag(of["error"]),
            _error_flag(of["custom"]["error"]),
            F.lit(False),
        )
    )
    return F.when(of.isNotNull(), F.when(failed, 2).otherwise(0))


def _span_attributes(of, custom_text):
    """Custom attributes as they are, then the reserved fields custom does not have itself."""
    custom = F.when(of["custom"].isNotNull(), custom_text)
    added = []
    for name in RESERVED_SPAN_FIELDS:
        free = of["custom"][name].isNull() & (J.kind_of(of[name]) != "VOID")
        added += [F.lit(name), F.when(free, of[name])]
    merged = J.object_of(J.members(custom), J.members(F.to_json(F.named_struct(*added))))
    return F.nullif(merged, F.lit("{}"))


def span_columns(of, custom_text):
    """Expressions of the span columns an event has data for, by name.

    ``of`` holds the ``FIELDS`` of the event's attributes, ``custom_text`` is the source text of ``custom``.
    """
    start = iso_to_nanos(J.as_string(of["start_timestamp"]))
    end = iso_to_nanos(J.as_string(of["end_timestamp"]))
    measured = J.as_number(of["custom"]["duration"]).try_cast("long")
    return {
        "start_time_unix_nano": start,
        "duration_time_unix_nano": F.coalesce(end - start, measured),
        "trace_id": J.as_string(of["trace_id"]),
        "span_id": J.as_string(of["span_id"]),
        "parent_span_id": J.as_string(of["parent_id"]),
        "service_name": J.as_string(of["service"]),
        "name": F.coalesce(
            J.as_string(of["custom"]["operation_name"]),
            J.as_string(of["operation_name"]),
            J.as_string(of["resource_name"]),
        ),
        "kind": _span_kind(of["custom"], of["tags"]),
        "status_code": _status_code(of),
        "status_status_message": F.coalesce(
            J.string_at(of["error"], "$.message"),
            J.string_at(of["custom"]["error"], "$.message"),
        ),
        "resource_attributes": J.ordered_object(
            ("host", J.as_string(of["host"])),
            ("env", J.as_string(of["env"])),
            ("ddtags", J.non_empty_array_at(of["tags"], "$")),
        ),
        "span_attributes": _span_attributes(of, custom_text),
    }


def normalise_spans(pages, carry=(), on_malformed="raise"):
    """Span rows of landing pages: a pure projection over one explode, no shuffle."""
    events = explode_attributes(pages, FIELDS, "custom", carry, on_malformed)
    columns = span_columns(F.col("event.of"), F.col("event.text.custom"))
    return events.select(*carry, *schemas.project(schemas.SPANS, columns))
