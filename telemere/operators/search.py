"""Search predicates on normalised relations.

A search is a plain conjunction of column predicates: on Parquet tables Catalyst
turns equality and time bounds into pushed filters and, with ``index`` and ``dt``
partition columns, into pruned partitions.
"""

import re
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import functions as F

from telemere.functions.otel import tag_value

TIME_COLUMN = {"logs": "time_unix_nano", "spans": "start_time_unix_nano", "metrics": "time_unix_nano"}
ATTRIBUTES = {"logs": "log_attributes", "spans": "span_attributes"}

# Search facet names that are columns of a relation.
FACET_COLUMNS = {
    "logs": {
        "service": "service_name",
        "status": "severity_text",
        "trace_id": "trace_id",
        "span_id": "span_id",
    },
    "spans": {
        "service": "service_name",
        "operation_name": "name",
        "trace_id": "trace_id",
        "span_id": "span_id",
    },
}
# Nanoseconds per duration unit.
DURATION_NANOS = {
    "ns": 1,
    "us": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

SORTS = ("timestamp", "-timestamp")


def facet(name, relation="logs"):
    """Text of a facet: a column, ``@attribute`` path, ``host``, or else a resource tag."""
    if not name:
        raise ValueError("a facet needs a name")
    if name.startswith("@"):
        path = name[1:]
        nested = F.get_json_object(ATTRIBUTES[relation], f"$.{path}")
        if "." not in path:
            return nested
        return F.coalesce(nested, F.get_json_object(ATTRIBUTES[relation], f"$['{path}']"))
    if name in FACET_COLUMNS[relation]:
        return F.col(FACET_COLUMNS[relation][name])
    if name == "host":
        return F.get_json_object("resource_attributes", "$.host")
    tags = F.from_json(F.get_json_object("resource_attributes", "$.ddtags"), "array<string>")
    tagged = tag_value(tags, name)
    if name == "env":
        return F.coalesce(F.get_json_object("resource_attributes", "$.env"), tagged)
    return tagged


def measure(value):
    """A number, or a duration such as '1.5s' in nanoseconds."""
    if isinstance(value, (int, float)):
        return value
    match = re.fullmatch(r"([0-9]+(?:[.][0-9]+)?)\s*(ns|us|ms|s|m|h)?", value)
    if not match:
        raise ValueError(f"not a number or duration: {value!r}")
    amount = float(match[1]) if "." in match[1] else int(match[1])
    return amount * DURATION_NANOS[match[2]] if match[2] else amount


_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
}


def predicates(facets=None, attr_range=None, text=None, relation="logs"):
    """Column predicates of a structured search, repeated terms dropped.

    ``facets`` maps facet names to a wanted text, ``attr_range`` maps ``@attribute``
    to ``(op, number or duration)`` or a list of those, ``text`` must occur in the
    message (for spans, in the name).
    """
    terms = {}
    for name, wanted in (facets or {}).items():
        terms[("=", name, wanted)] = facet(name, relation) == wanted
    for name, tests in (attr_range or {}).items():
        for op, bound in [tests] if isinstance(tests, tuple) else tests:
            value = facet(name, relation).try_cast("double")
            terms[(op, name, bound)] = _COMPARE[op](value, F.lit(measure(bound)))
    if text:
        terms[("~", text)] = F.col("body" if relation == "logs" else "name").contains(text)
    return list(terms.values())


def where_all(df, tests):
    """Rows passing every test; all rows when there is none (the ``*`` search)."""
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def _day(nanos):
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=nanos // 1_000_000_000)).date()


def where_time(df, start_nanos=None, end_nanos=None, time="time_unix_nano"):
    """Rows in ``[start_nanos, end_nanos)``; prunes ``dt`` partitions when the table has them."""
    tests = []
    partitioned = "dt" in df.columns
    if start_nanos is not None:
        tests.append(F.col(time) >= start_nanos)
        if partitioned:
            tests.append(F.col("dt") >= F.lit(_day(start_nanos)))
    if end_nanos is not None:
        tests.append(F.col(time) < end_nanos)
        if partitioned:
            tests.append(F.col("dt") <= F.lit(_day(end_nanos - 1)))
    return where_all(df, tests)


def where_window(df, window, time="time_unix_nano"):
    """Rows of a resolved search window; an impossible window gives an empty relation."""
    if window.empty:
        return df.where(F.lit(False))
    return where_time(df, window.start_nanos, window.end_nanos, time)


def where_index(df, indexes):
    """Rows of the given indexes (all when empty): a partition filter on landing tables."""
    return df.where(F.col("index").isin(*indexes)) if indexes else df


def sorted_by(df, sort="timestamp", time="time_unix_nano", tiebreak=()):
    """Rows in search order: ``timestamp`` ascending or ``-timestamp`` descending."""
    if sort not in SORTS:
        raise ValueError(f"cannot sort by {sort!r}; known orders: {', '.join(SORTS)}")
    order = F.desc_nulls_last(time) if sort == "-timestamp" else F.asc_nulls_last(time)
    return df.orderBy(order, *tiebreak)


def combine_terms(query, terms):
    """Text of a search after adding terms: ``*`` is replaced, anything else is kept in brackets."""
    added = " AND ".join(dict.fromkeys(terms))
    if not added:
        return query
    return added if query == "*" else f"({query}) AND {added}"
