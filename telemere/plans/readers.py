"""Readers over landing folders, with the arguments and defaults of the search API.

All return DataFrames with fixed schemas. Jobs run when a reader is called for three things only: a row
cap finds its last key, overlapping reads (see ``operators.coverage``) find the times they own, and an index
(see ``plans.file_index``) finds the files that may hold a facet's value or a text. ``from_`` and ``to`` are resolved
when the reader is called; pass ``now_ms`` or ``now`` to pin them. ``page_size``,
``retries``, ``timeout`` and ``secret`` belong to whatever lands the pages: they
are checked here and change nothing else.
"""

import time as _time

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions.window import metrics_window, search_window, service_map_window
from telemere.operators import correlate, coverage, paging, search, stats
from telemere.operators.lookups import bounded, key_bitmap, maybe_among
from telemere.plans import file_index
from telemere.plans.options import NotConfigured, Provider, check_limits
from telemere.sources.aggregates import normalise_indexes
from telemere.sources.alerts import normalise_alerts
from telemere.sources.dependencies import normalise_dependencies
from telemere.sources.logs import normalise_logs
from telemere.sources.metrics import normalise_metrics
from telemere.sources.spans import normalise_spans


def _inside(pages, window):
    """Landed pages that may hold events of the window: by their own times, and by the day of their latest event."""
    if "last_nanos" not in pages.columns:
        return pages
    untimed = F.col("last_nanos").isNull()
    pages = pages.where(untimed | ((F.col("last_nanos") >= window.start_nanos) & (F.col("first_nanos") < window.end_nanos)))
    if "dt" in pages.columns:
        first_day = F.to_date(F.timestamp_millis(F.lit(window.start)))
        pages = pages.where(F.col("dt").isNull() | (F.col("dt") >= first_day))
    return pages


def _with_pieces(reads, name, source, bodies=None):
    """``reads`` that own some time, with ``_pieces``: each instant belongs to the newest read that covers it.

    Reads are few and narrow next to what they hold; their times are worked out when this is called.
    ``bodies`` are the rows to go on with, where some of the reads' rows hold nothing that is wanted.
    """
    owned = coverage.owned_times(reads.select(name.alias("read"), "from", "to", F.col("received_unix_nano").alias("taken"), *source), source)
    return (reads if bodies is None else bodies).withColumn("_read", name).join(
        bounded(owned.select(F.col("read").alias("_read"), F.col("pieces").alias("_pieces"))), "_read"
    )


def _covered(rows, time):
    """Rows that belong to their read; times outside what it asked for count as its first or last instant."""

    def owned(at):
        instant = F.call_function("div", at, F.lit(1_000_000))
        clamped = F.greatest("_from", F.least(F.col("_to") - 1, instant))
        return coverage.is_owned(F.col("_pieces"), F.when(instant.isNotNull(), clamped))

    # Bound by a lambda: the filter is pushed down to the JSON, and a time is read once a row, not for each piece.
    return rows.where(F.get(F.transform(F.array(F.col(time)), owned), F.lit(0)))


_SCAN = ("from_ms", "to_ms", "received_unix_nano")


def _search(pages, normalise, relation, window, tests, max_rows, schema, on_malformed, newest_first=False, only=None):
    """Matching rows of ``pages``; ``only`` are those of them that may hold matches, if fewer."""
    time = search.TIME_COLUMN[relation]
    carry = ()
    if set(_SCAN) <= set(pages.columns):
        # The reads of all time matter, not only those with pages inside the window.
        source = ["index"] if "index" in pages.columns else []
        bounds = {"from": F.col("from_ms"), "to": F.col("to_ms")}
        bodies = None if only is None else only.withColumns(bounds)
        pages = _with_pieces(pages.withColumns(bounds), F.col("scan_id"), source, bodies)
        pages = pages.withColumns({"_from": F.col("from"), "_to": F.col("to")})
        carry = ("_from", "_to", "_pieces")
    elif only is not None:
        pages = only
    rows = normalise(paging.assemble_cursor_pages(_inside(pages, window)), carry, on_malformed=on_malformed)
    rows = search.where_window(rows, window, time)
    if carry:
        rows = _covered(rows, time).drop(*carry)
    matching = search.where_all(rows, tests)
    return paging.cap_rows(matching, max_rows, time, newest_first).select(*schema.fieldNames())


def _indexed(spark, landing, kind, pages, facets, text):
    """The pages an index leaves to be read; it is asked only where chains were cut when pages landed."""
    return file_index.candidates(spark, landing, kind, facets, text) if "live" in pages.columns else None


def _matching_logs(spark, landing, facets, attr_range, text, from_, to, indexes, now_ms, max_rows, on_malformed, newest_first=False):
    """Matching log rows in no order: what aggregates read."""
    window = search_window(from_, to, now_ms)
    pages = search.where_index(landing.table(spark, "logs"), indexes)
    tests = search.predicates(facets, attr_range, text, "logs")
    only = _indexed(spark, landing, "logs", pages, facets, text)
    only = None if only is None else search.where_index(only, indexes)
    return _search(pages, normalise_logs, "logs", window, tests, max_rows, schemas.LOGS, on_malformed, newest_first, only)


def read_logs(
    spark,
    landing,
    facets=None,
    attr_range=None,
    text=None,
    from_="now-15m",
    to="now",
    sort="timestamp",
    page_size=1000,
    max_rows=0,
    retries=4,
    timeout=60,
    secret=None,
    indexes=(),
    now_ms=None,
    on_malformed="raise",
):
    """Log rows of a window that match a structured search; all indexes unless some are named."""
    check_limits(sort, page_size, max_rows, retries, timeout)
    newest_first = sort == "-timestamp"
    found = _matching_logs(spark, landing, facets, attr_range, text, from_, to, indexes, now_ms, max_rows, on_malformed, newest_first)
    return paging.order_by_time(found, "time_unix_nano", newest_first)


def read_spans(
    spark,
    landing,
    facets=None,
    attr_range=None,
    text=None,
    from_="now-15m",
    to="now",
    sort="timestamp",
    page_size=1000,
    max_rows=0,
    retries=4,
    timeout=60,
    secret=None,
    now_ms=None,
    on_malformed="raise",
):
    """Span rows of a window that match a structured search."""
    check_limits(sort, page_size, max_rows, retries, timeout)
    window = search_window(from_, to, now_ms)
    tests = search.predicates(facets, attr_range, text, "spans")
    pages, newest_first = landing.table(spark, "spans"), sort == "-timestamp"
    only = _indexed(spark, landing, "spans", pages, facets, text)
    found = _search(pages, normalise_spans, "spans", window, tests, max_rows, schemas.SPANS, on_malformed, newest_first, only)
    return paging.order_by_time(found, search.TIME_COLUMN["spans"], newest_first)


def read_metrics(
    spark,
    landing,
    query,
    from_="now-15m",
    to="now",
    max_rows=0,
    retries=4,
    timeout=60,
    secret=None,
    provider=Provider(),
    now=None,
    on_malformed="raise",
):
    """Points of the landed responses to ``query`` inside a window, each instant from the newest response covering it."""
    check_limits(max_rows=max_rows, retries=retries, timeout=timeout)
    if not (query or "").strip():
        raise NotConfigured("metrics need a query, such as 'avg:system.cpu.user{*}'")
    window = metrics_window(from_, to, now)
    responses = landing.table(spark, "metrics").where(
        (F.col("query") == query.strip()) & (F.col("end_s") >= window.start) & (F.col("start_s") <= window.end)
    )
    carry = ()
    if {"scan_id", "received_unix_nano"} <= set(responses.columns):
        # Both ends of a response's range belong to it.
        timed = responses.withColumns({"from": F.col("start_s") * 1000, "to": (F.col("end_s") + 1) * 1000})
        responses = _with_pieces(timed, F.col("scan_id"), []).withColumns({"_from": F.col("from"), "_to": F.col("to")})
        carry = ("_from", "_to", "_pieces")
    points = normalise_metrics(responses, provider.name, provider.site, carry, on_malformed=on_malformed)
    inside = search.where_time(points, window.start_nanos, window.end_nanos + 1)
    if carry:
        inside = _covered(inside, "time_unix_nano").drop(*carry)
    return paging.cap_rows(inside, max_rows)


def read_log_stats(
    spark,
    landing,
    facets=None,
    attr_range=None,
    text=None,
    from_="now-15m",
    to="now",
    compute="count",
    metric=None,
    group_by=(),
    group_limit=10,
    retries=4,
    timeout=60,
    secret=None,
    approx=False,
    now_ms=None,
):
    """Aggregated ``(by, value)`` rows over the matching logs; arguments are checked first."""
    options = stats.StatsOptions(compute, metric, group_by, group_limit, approx, retries, timeout)
    rows = _matching_logs(spark, landing, facets, attr_range, text, from_, to, (), now_ms, 0, "raise")
    return stats.log_stats(rows, options)


def read_open_alerts(spark, landing, retries=4, timeout=60, secret=None, on_malformed="raise"):
    """Monitor groups that are triggered now, one row each.

    Where the landed scans say when they were received, the newest scan of each ``scope`` is the current
    state, whatever older ones held; a group that several scopes list counts as its newest scan says.
    """
    check_limits(retries=retries, timeout=timeout)
    pages = landing.table(spark, "alerts")
    if "received_unix_nano" not in pages.columns:
        return normalise_alerts(paging.assemble_offset_pages(pages), on_malformed=on_malformed)
    scope = ["scope"] if "scope" in pages.columns else []
    newest = pages.groupBy(*scope).agg(F.max_by("scan_id", F.struct("received_unix_nano", "scan_id")).alias("scan_id"))
    # A bitmap of the newest scans leaves the bodies of the others where they are.
    current = pages.where(maybe_among(key_bitmap(newest, "scan_id"), "scan_id")).join(newest.select("scan_id"), "scan_id", "left_semi")
    groups = normalise_alerts(
        paging.assemble_offset_pages(current), ("received_unix_nano", "scan_id"), open_only=False, on_malformed=on_malformed
    )
    latest = correlate.latest_state(groups, "received_unix_nano", (F.desc("scan_id"),))
    return latest.select(*schemas.ALERTS.fieldNames())


def read_service_dependencies(
    spark,
    landing,
    env,
    from_="-1h",
    to="now",
    primary_tag=None,
    retries=4,
    timeout=60,
    secret=None,
    provider=Provider(),
    now=None,
    on_malformed="raise",
):
    """Distinct service edges of one environment, from responses inside a window."""
    check_limits(retries=retries, timeout=timeout)
    if not env:
        raise NotConfigured("the service map needs an environment (env)")
    if not from_ or not to:
        raise ValueError("from and to must not be empty")
    window = service_map_window(from_, to, int(_time.time()) if now is None else now)
    responses = landing.table(spark, "service_dependencies").where(
        (F.col("environment") == env)
        & F.col("primary_tag").eqNullSafe(F.lit(primary_tag).cast("string"))
        & (F.col("start_s") >= window.start)
        & (F.col("end_s") <= window.end)
    )
    return normalise_dependencies(responses, provider.name, env, window, on_malformed)


def read_indexes(spark, landing, on_malformed="raise"):
    """Index names in the order the API listed them."""
    return normalise_indexes(landing.table(spark, "indexes"), (), on_malformed).orderBy("position", "name")
