"""Log intake requests: framing, whole-request validation, and the 18-column log rows.

A request row has ``request_id``, ``received_unix_nano`` (BIGINT), ``content_type``,
``api_key`` and ``body``. It is judged before anything is exploded, so a bad
request contributes no rows at all.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemere import schemas
from telemere.functions import json as J
from telemere.functions.otel import split_tags, status_to_severity, trim_blanks
from telemere.functions.time import iso_to_nanos, millis_to_nanos

REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("received_unix_nano", T.LongType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("api_key", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)
REJECTS = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("code", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Body limit, array limit, line-framed media types, keys kept out of log_attributes.
MAX_BODY_BYTES = 5 * 1024 * 1024
MAX_ARRAY_LOGS = 1000
LINE_MEDIA_TYPES = ("application/x-ndjson", "application/ndjson", "text/plain")
RESERVED_KEYS = ("message", "service", "status", "timestamp", "hostname", "host", "ddtags", "ddsource")

ACCEPTED, BAD_REQUEST, FORBIDDEN, TOO_LARGE = 202, 400, 403, 413


def _documents(content_type, body):
    """JSON documents of a body: its non-blank lines, or the whole of it."""
    media_type = F.lower(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1))
    lines = F.filter(F.transform(F.split(body, "\n"), trim_blanks), lambda line: line != "")
    return F.when(media_type.isin(*LINE_MEDIA_TYPES), lines).otherwise(F.array(body))


def _document_problem(entry):
    doc, elements = entry["doc"], J.array_at(entry["doc"], "$")
    return (
        F.when(doc.isNull(), F.lit("the body cannot be read as JSON"))
        .when(F.size(elements) > MAX_ARRAY_LOGS, F.lit(f"the body has an array of more than {MAX_ARRAY_LOGS} logs"))
        .when(F.exists(elements, lambda e: ~J.is_object(e)), F.lit("the body has an entry that is no object"))
        .when(elements.isNull() & ~J.is_object(doc), F.lit("the body is neither an object nor an array"))
    )


def _document_logs(entry):
    """Log objects of one sound document as (text, doc)."""
    texts = F.from_json(entry["text"], "array<string>", J.STRICT)
    elements = J.array_at(entry["doc"], "$")
    many = F.zip_with(texts, elements, lambda t, d: F.struct(t.alias("text"), d.alias("doc")))
    return F.when(elements.isNotNull(), many).otherwise(F.array(entry))


def assess(requests, api_key="", max_body_bytes=MAX_BODY_BYTES):
    """Add ``documents``, ``code`` and ``reason`` to every request.

    Too large comes before a wrong key, a wrong key before a bad body, and the
    body of a request refused for the first two is not parsed.
    """
    too_large = F.octet_length("body") > max_body_bytes
    forbidden = F.coalesce(F.col("api_key"), F.lit("")) != api_key if api_key else F.lit(False)
    documents = F.when(~(too_large | forbidden), _documents(F.col("content_type"), F.col("body")))
    wrapped = F.transform(documents, lambda t: F.struct(t.alias("text"), J.wrap(t).alias("wrapped")))
    framed = requests.withColumns({"_wrapped": wrapped, "too_large": too_large, "forbidden": forbidden})
    parsed = F.transform(
        "_wrapped",
        lambda w: F.struct(w["text"].alias("text"), J.unwrap(w["wrapped"], w["text"]).alias("doc")),
    )
    framed = framed.withColumn("documents", parsed).drop("_wrapped")
    problem = F.get(
        F.filter(F.transform("documents", _document_problem), lambda p: p.isNotNull()), F.lit(0)
    )
    reason = (
        F.when(F.col("too_large"), F.lit("the body is over the size limit"))
        .when(F.col("forbidden"), F.lit("the key does not match"))
        .when(F.col("body").isNull(), F.lit("the body cannot be read as JSON"))
        .otherwise(problem)
    )
    code = (
        F.when(F.col("too_large"), TOO_LARGE)
        .when(F.col("forbidden"), FORBIDDEN)
        .when(F.col("reason").isNotNull(), BAD_REQUEST)
        .otherwise(ACCEPTED)
    )
    return framed.withColumn("reason", reason).withColumn("code", code.cast("int"))


def _timestamp(doc, received):
    """Number or digit string of milliseconds, else ISO text, else the receive time."""
    number = F.when(
        J.is_number_kind(J.kind(doc, "$.timestamp")), F.try_variant_get(doc, "$.timestamp", "decimal(30,9)")
    )
    text = J.string_at(doc, "$.timestamp")
    digits = F.when(text.rlike(r"^\s*[+-]?\d+$"), F.trim(text).try_cast("decimal(30,9)"))
    return F.coalesce(millis_to_nanos(F.coalesce(number, digits)), iso_to_nanos(text), received)


def _message(doc, text):
    kind = J.kind(doc, "$.message")
    value = (
        F.when(kind == "STRING", F.try_variant_get(doc, "$.message", "string"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind.isNotNull(), F.get_json_object(text, "$.message"))
    )
    return F.nullif(value, F.lit(""))


def _log_attributes(text):
    kept = F.map_filter(J.first_of_repeated(J.typed_map(text)), lambda k, _: ~k.isin(*RESERVED_KEYS))
    return F.nullif(F.to_json(kept), F.lit("{}"))


def intake_columns(doc, text, received):
    """Expressions of the log columns an intake object has data for, by name."""
    status = J.string_at(doc, "$.status")
    return {
        "time_unix_nano": _timestamp(doc, received),
        "observed_time_unix_nano": received,
        "trace_id": F.coalesce(J.string_at(doc, "$['dd.trace_id']"), J.string_at(doc, "$.trace_id")),
        "span_id": F.coalesce(J.string_at(doc, "$['dd.span_id']"), J.string_at(doc, "$.span_id")),
        "service_name": J.string_at(doc, "$.service"),
        "severity_number": status_to_severity(status),
        "severity_text": status,
        "body": _message(doc, text),
        "resource_attributes": J.ordered_object(
            ("host", F.coalesce(J.string_at(doc, "$.hostname"), J.string_at(doc, "$.host"))),
            ("ddsource", J.string_at(doc, "$.ddsource")),
            ("ddtags", split_tags(J.string_at(doc, "$.ddtags"))),
        ),
        "log_attributes": _log_attributes(text),
    }


def accepted_logs(assessed, carry=()):
    """Log rows of the accepted requests; a request is bounded by the body limit."""
    logs = F.when(F.col("code") == ACCEPTED, F.flatten(F.transform("documents", _document_logs)))
    rows = assessed.select(*carry, "received_unix_nano", F.explode(logs).alias("log"))
    columns = intake_columns(F.col("log.doc"), F.col("log.text"), F.col("received_unix_nano"))
    return rows.select(*carry, *schemas.project(schemas.LOGS, columns))


def judged_logs(assessed):
    """Log rows of accepted requests and one row for each refused request, told apart by ``code``, in one pass.

    An accepted request without logs has no row.
    """
    logs = F.when(F.col("code") == ACCEPTED, F.flatten(F.transform("documents", _document_logs)))
    rows = assessed.select("request_id", "code", "reason", "received_unix_nano", F.explode_outer(logs).alias("log"))
    rows = rows.where(F.col("log").isNotNull() | (F.col("code") != ACCEPTED))
    columns = intake_columns(F.col("log.doc"), F.col("log.text"), F.col("received_unix_nano"))
    return rows.select("request_id", "code", "reason", *schemas.project(schemas.LOGS, columns))


def rejected_requests(assessed):
    """Refused requests with their status code and reason."""
    refused = assessed.where(F.col("code") != ACCEPTED)
    return refused.select("request_id", "code", "reason")


def normalise_intake(requests, api_key="", max_body_bytes=MAX_BODY_BYTES, carry=()):
    """Log rows of all sound requests."""
    return accepted_logs(assess(requests, api_key, max_body_bytes), carry)
