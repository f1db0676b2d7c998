"""Nanosecond time arithmetic as column expressions."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

NANOS_PER_MILLI = 1_000_000
NANOS_PER_SECOND = 1_000_000_000
_UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")

_DATE_START = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
_DATE_ONLY = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_HAS_OFFSET = r"([+-]\d{1,2}(:?\d{2})?(:\d{2})?|[A-Za-z]+)\s*$"
_BELOW_MICROS = r"[.]\d{6}(\d{1,3})"


def _div(a, b):
    return F.call_function("div", a, b)


def floor_ms(nanos):
    """Milliseconds of epoch nanoseconds, rounded down, exact over the BIGINT range."""
    million = F.lit(NANOS_PER_MILLI).cast("long")
    return _div(nanos, million) - F.when(nanos % million < 0, 1).otherwise(0)


def ceil_ms(nanos):
    """Milliseconds of epoch nanoseconds, rounded up, exact over the BIGINT range."""
    million = F.lit(NANOS_PER_MILLI).cast("long")
    return _div(nanos, million) + F.when(nanos % million > 0, 1).otherwise(0)


def truncate_ms(nanos):
    """Milliseconds of epoch nanoseconds, cut towards zero."""
    return _div(nanos, F.lit(NANOS_PER_MILLI).cast("long"))


def event_time(nanos):
    """Spark timestamp (microseconds) of epoch nanoseconds."""
    micros = _div(nanos, F.lit(1000).cast("long")) - F.when(nanos % 1000 < 0, 1).otherwise(0)
    return F.timestamp_micros(micros)


def nanos_of_timestamp(ts):
    """Epoch nanoseconds of a timestamp column; NULL outside the nanosecond range."""
    return F.try_multiply(F.unix_micros(ts), F.lit(1000).cast("long"))


def _session_is_utc():
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def iso_to_nanos(text):
    """Epoch nanoseconds of ISO-8601 text.

    Offsets are honoured, text without one is UTC whatever the session zone is,
    digits seven to nine of the fraction are kept, and anything else is NULL.
    ``text`` is named as few times as possible: filters repeat it in full.
    """
    zoned = text
    if not _session_is_utc():
        zoned = (
            F.when(text.rlike(_DATE_ONLY), F.concat(F.trim(text), F.lit("T00:00:00Z")))
            .when(F.substring(text, 11, 2147483647).rlike(_HAS_OFFSET), text)
            .otherwise(F.concat(F.trim(text), F.lit("Z")))
        )
    base = nanos_of_timestamp(F.when(text.rlike(_DATE_START), zoned).try_cast("timestamp"))
    below = F.rpad(F.regexp_extract(text, _BELOW_MICROS, 1), 3, "0").cast("long")
    return F.try_add(base, F.when(text.contains("."), below).otherwise(F.lit(0).cast("long")))


def millis_to_nanos(millis):
    """Epoch nanoseconds of epoch milliseconds in a ``decimal(30,9)`` column, cut towards zero."""
    return (millis * F.lit(NANOS_PER_MILLI).cast("decimal(7,0)")).try_cast("long")
