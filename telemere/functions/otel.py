"""Severity, span-kind, identifier and tag rules as column expressions."""

from functools import reduce

from pyspark.sql import functions as F

# Log status (lower case) -> OTLP severity number; any other status is 0.
STATUS_TO_SEVERITY = {
    "trace": 1,
    "debug": 5,
    "info": 9,
    "notice": 9,
    "ok": 9,
    "warn": 13,
    "warning": 13,
    "error": 17,
    "err": 17,
    "critical": 21,
    "crit": 21,
    "alert": 21,
    "emergency": 21,
    "fatal": 21,
}

# First and last OTLP severity number of each log status.
SEVERITY_RANGES = {
    "trace": (1, 4),
    "debug": (5, 8),
    "info": (9, 12),
    "warn": (13, 16),
    "error": (17, 20),
    "critical": (21, 24),
}

# OTLP span kinds.
SPAN_KINDS = {"internal": 1, "server": 2, "client": 3, "producer": 4, "consumer": 5}

# Fixed value: bytes counted per log on top of its field lengths.
LOG_ENVELOPE_BYTES = 256

_BLANKS = " \t\n\r\x0b\x0c"


def trim_blanks(text):
    """Trim spaces, tabs and line breaks."""
    return F.btrim(text, F.lit(_BLANKS))


def _lookup(value, table):
    """Entry of a fixed table, NULL when there is none; ``value`` is evaluated once."""
    return F.try_element_at(F.create_map(*[F.lit(part) for entry in table.items() for part in entry]), value)


def status_to_severity(status):
    """OTLP severity number of a log status; 0 for an unknown one, NULL for NULL."""
    return F.when(status.isNotNull(), F.coalesce(_lookup(F.lower(status), STATUS_TO_SEVERITY), F.lit(0)))


def severity_to_status(number):
    """Log status of an OTLP severity number; '' outside 1-24."""
    chain = F
    for status, (low, high) in SEVERITY_RANGES.items():
        chain = chain.when(number.between(low, high), F.lit(status))
    return chain.otherwise(F.lit(""))


def known_kind(kind):
    """OTLP kind number of a span kind name, with or without its SPAN_KIND_ prefix; NULL if unknown. Names ``kind`` once."""
    return _lookup(F.regexp_replace(F.lower(kind), "^span_kind_", ""), SPAN_KINDS)


def kind_to_int(kind):
    """OTLP kind number of a span kind name, with or without its SPAN_KIND_ prefix; 0 if unknown."""
    return F.when(kind.isNotNull(), F.coalesce(known_kind(kind), F.lit(0)))


def int_to_kind(number):
    """Span kind name of an OTLP kind number; NULL outside 1-5."""
    return _lookup(number.cast("int"), {n: name for name, n in SPAN_KINDS.items()})


def hex_digits(text):
    """The 1-32 hex digits of an identifier without blanks and 0x prefix; NULL if it is not one."""
    bare = F.regexp_replace(trim_blanks(text), "^0[xX]", "")
    return F.when(bare.rlike("^[0-9a-fA-F]{1,32}$"), bare)


def hex_low(digits):
    """Unsigned value of the last 16 hex digits, as DECIMAL(20,0)."""
    return F.conv(F.right(digits, F.lit(16)), 16, 10).cast("decimal(20,0)")


def hex_high(digits):
    """The digits above the last 16, lower case without leading zeros; '' if there are none."""
    upper = F.substring(F.lower(F.lpad(digits, 32, "0")), 1, 16)
    return F.ltrim(upper, F.lit("0"))


def tag_value(tags, *keys):
    """Value of the first ``key:value`` tag that has one of ``keys``; NULL if none or empty."""
    prefixes = [f"{key}:" for key in keys]
    hit = F.get(
        F.filter(tags, lambda t: reduce(lambda a, b: a | b, [t.startswith(p) for p in prefixes])), F.lit(0)
    )
    chain = F
    for prefix in prefixes:
        chain = chain.when(hit.startswith(prefix), F.substring(hit, len(prefix) + 1, 2**31 - 1))
    return F.nullif(chain, F.lit(""))


def split_tags(text):
    """Comma-separated tags as an array: trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(text, ","), trim_blanks), lambda t: t != "")


def estimate_log_bytes(*texts):
    """Upper estimate of a log's outbound size from its text fields."""
    sizes = [F.coalesce(F.octet_length(t), F.lit(0)) for t in texts]
    return reduce(lambda a, b: a + b, sizes, F.lit(LOG_ENVELOPE_BYTES)).cast("long")
