"""Log search events as the 18-column log relation."""

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.functions.otel import status_to_severity
from telemere.functions.time import iso_to_nanos
from telemere.sources.pages import explode_events


def log_columns(doc, text):
    """Expressions of the log columns an event has data for, by name."""
    status = J.string_at(doc, "$.attributes.status")
    time = iso_to_nanos(J.string_at(doc, "$.attributes.timestamp"))
    return {
        "time_unix_nano": time,
        "observed_time_unix_nano": time,
        "trace_id": J.string_at(doc, "$.attributes.attributes.trace_id"),
        "span_id": J.string_at(doc, "$.attributes.attributes.span_id"),
        "service_name": J.string_at(doc, "$.attributes.service"),
        "severity_number": status_to_severity(status),
        "severity_text": status,
        "body": J.string_at(doc, "$.attributes.message"),
        "resource_attributes": J.ordered_object(
            ("host", J.string_at(doc, "$.attributes.host")),
            ("ddtags", J.non_empty_array_at(doc, "$.attributes.tags")),
        ),
        "log_attributes": J.object_text(doc, text, "$.attributes.attributes"),
    }


def normalise_logs(pages, carry=(), on_malformed="raise"):
    """Log rows of landing pages: a pure projection over one explode, no shuffle.

    Unused columns cost nothing: Catalyst drops their JSON expressions.
    """
    events = explode_events(pages, carry, on_malformed)
    columns = log_columns(F.col("event.doc"), F.col("event.text"))
    return events.select(*carry, *schemas.project(schemas.LOGS, columns))
