"""Assembly of landed pages, row caps and range splitting.

Page chains are cut without sorting or gathering a scan: whether a page ends its
chain is a property of the page (or of a running total built from block sums), so
the last page is a plain minimum per scan. Pages landed through ``plans.landing`` have the
outcome as a column, and reading them joins nothing.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemere.operators.lookups import key_bitmap, maybe_among
from telemere.session import shared_dir
from telemere.sources.alerts import ALERT_PAGE_SIZE, with_alert_page_header
from telemere.sources.pages import with_page_header

# Pages summed as one block in running totals.
BLOCK_PAGES = 1024
# Rows of a cap that an ordered limit may keep in each task.
HEAP_ROWS = 1000
# Buckets of time that are counted to find the last row of a cap, and keys that one task may sort to find it.
TIME_BUCKETS = 4096
RUN_ROWS = 1_000_000


def _with_live(pages, chains, look):
    """Add ``live``: whether a page counts, given ``scan_id``, ``last_page`` and ``top_page`` of the chains.

    Only scans with pages behind their last one need a look at it. A bitmap of those scans
    clears all others, whose bodies stay where they are. With ``look`` a job finds out first whether there are any.
    """
    if "live" in pages.columns:
        return pages
    cut = chains.where("top_page > last_page").select("scan_id", "last_page")
    if look and cut.isEmpty():
        return pages.withColumn("live", F.lit(True))
    doubtful = maybe_among(key_bitmap(cut, "scan_id"), "scan_id")
    clear = pages.where(~doubtful).withColumn("live", F.lit(True))
    joined = pages.where(doubtful).join(cut, "scan_id", "left").select(*pages.columns, "last_page")
    checked = joined.withColumn("live", F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page")))
    return clear.unionByName(checked.drop("last_page"))


def _last_pages(heads, ends):
    last, top = F.min(F.when(ends, F.col("page_no"))), F.max("page_no")
    return heads.groupBy("scan_id").agg(last.alias("last_page"), top.alias("top_page"))


def _live_only(marked, columns):
    return marked.where(F.coalesce("live", F.lit(True))).select(*columns)


def with_cursor_chain(pages, look=False):
    """Add ``live``: whether a cursor walk would fetch the page. Nothing is computed when the pages have it.

    The walk ends with the first page that has no next cursor, no events, or a
    next cursor equal to its own; that page still counts. A page that is not JSON
    says nothing about the walk, so the pages landed behind it still count.
    """
    if "live" in pages.columns:
        return pages
    after, cursor = F.col("after"), F.coalesce(F.col("cursor"), F.lit(""))
    sound = F.col("n_rows").isNotNull()
    ends = sound & (after.isNull() | (after == "") | (F.col("n_rows") == 0) | (after == cursor))
    heads = with_page_header(pages).select("scan_id", "page_no", "cursor", "after", "n_rows")
    return _with_live(pages, _last_pages(heads, ends), look)


def assemble_cursor_pages(pages):
    """Pages a cursor walk would fetch; a plain filter on pages that were landed with their chain."""
    return _live_only(with_cursor_chain(pages), pages.columns)


def running_total(df, key, order, value):
    """Running sum of ``value`` along the dense integer ``order`` of each ``key``.

    Sorted groups never exceed one block: blocks are summed first, and only the
    block sums are accumulated over a whole key.
    """
    blocked = df.withColumn("_block", F.call_function("div", F.col(order), F.lit(BLOCK_PAGES)))
    sums = blocked.groupBy(key, "_block").agg(F.sum(value).alias("_sum"))
    ahead = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(key, "_block", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    inside = W.partitionBy(key, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    summed = blocked.withColumn("_inside", F.sum(value).over(inside)).join(starts, [key, "_block"])
    return summed.withColumn("running_total", F.col("_start") + F.col("_inside")).drop(
        "_block", "_start", "_inside"
    )


def with_offset_chain(pages, look=False):
    """Add ``live``: whether an offset walk would fetch the alert page.

    It ends with an empty page, when the groups seen so far reach the page's
    ``total_count``, or, without a total, with a short page; that page still counts.
    """
    if "live" in pages.columns:
        return pages
    heads = with_alert_page_header(pages).select("scan_id", "page_no", "n_rows", "total_count")
    seen = running_total(heads, "scan_id", "page_no", "n_rows")
    ends = (
        (F.col("n_rows") == 0)
        | (F.col("total_count").isNotNull() & (F.col("running_total") >= F.col("total_count")))
        | (F.col("total_count").isNull() & (F.col("n_rows") < ALERT_PAGE_SIZE))
    )
    return _with_live(pages, _last_pages(seen, ends), look)


def assemble_offset_pages(pages):
    """Alert pages an offset walk would fetch; a plain filter on pages that were landed with their chain."""
    return _live_only(with_offset_chain(pages), pages.columns)


def order_by_time(df, time="time_unix_nano", descending=False, tiebreak=()):
    """``df`` by time, then by ``tiebreak`` columns; rows without a time come last."""
    return df.orderBy(F.desc_nulls_last(time) if descending else F.asc_nulls_last(time), *tiebreak)


def cap_rows(df, max_rows, time="time_unix_nano", descending=False, tiebreak=()):
    """The first ``max_rows`` rows by time, as a relation later filters apply to; 0 is no cap.

    Rows without a time come last. Rows of one time are taken in the order of the
    ``tiebreak`` columns and then of a hash of the whole row, so the same table gives
    the same rows for every cap and on every read. Up to ``HEAP_ROWS`` rows are an ordered limit. A larger
    cap becomes a filter on time, which scans can push down, and, for rows of the very last
    time only, on the tie-break: that time is found from counts and a narrow copy of
    the times near it, and no task or heap holds the capped rows. Finding it runs jobs.
    """
    if max_rows < 0:
        raise ValueError("max_rows is negative; give 0 for no cap")
    if max_rows == 0:
        return df
    ties = [*map(F.col, tiebreak), F.xxhash64(F.to_json(F.struct(*df.columns)))]
    if max_rows <= HEAP_ROWS:
        return df.orderBy(F.desc_nulls_last(time) if descending else F.asc_nulls_last(time), *ties).limit(max_rows)
    position = F.col(time) * (-1 if descending else 1)
    found = _last_key(_keys(df, [position.isNull(), position]), max_rows, "k1")
    if found is None:
        return df
    (_, last), wanted, there = found
    if last is None:
        before, at, through = F.col(time).isNotNull(), F.col(time).isNull(), F.lit(True)
    else:
        edge = F.lit(-last if descending else last)
        at = F.col(time) == edge
        before, through = (F.col(time) > edge, F.col(time) >= edge) if descending else (F.col(time) < edge, F.col(time) <= edge)
    near = df.where(through)
    if wanted == there:
        return near
    keys = _keys(df.where(at), ties)
    values, wanted, there = _last_key(keys, wanted)
    last = F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(keys.dtypes, values, strict=True)])
    key = F.struct(*[tie.alias(f"k{i}") for i, tie in enumerate(ties)])
    if wanted == there:
        return near.where(before | (at & (key <= last)))
    # The cap falls between rows that are equal in every column: any of them will do.
    return near.where(before | (at & (key < last))).unionByName(df.where(at).where(key == last).limit(wanted))


def _keys(df, columns):
    return df.select(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def _last_key(keys, max_rows, measure=None):
    """The values of the ``max_rows``-th key, how many rows with it are wanted, and how many there are; or None.

    The whole numbers of the column ``measure``, which leads the order, narrow down where it lies.
    """
    inside, before = keys, 0
    if measure:
        low, high, total = keys.agg(F.min(measure), F.max(measure), F.count(F.lit(1))).first()
        if total <= max_rows:
            return None
        if low is not None:
            width = (high - low) // TIME_BUCKETS + 1
            bucket = F.call_function("div", F.col(measure) - low, F.lit(width))
            counts = keys.groupBy(bucket.alias("bucket")).count().collect()
            for number, count in sorted(counts, key=lambda row: (row[0] is None, row[0] or 0)):
                if before + count >= max_rows:
                    break
                before += count
            inside = keys.where(bucket.eqNullSafe(F.lit(number)))
    wanted = max_rows - before
    names = keys.columns
    while True:
        # Sorted runs of the keys that are left, one a partition: equal keys are in one run.
        runs = _stored(inside.orderBy(*names).withColumn("run", F.spark_partition_id()))
        sizes = runs.groupBy("run").agg(F.count(F.lit(1)), F.min(F.struct(*names)), F.max(F.struct(*names))).collect()
        ahead = 0
        for run, size, least, most in sorted(sizes):
            if ahead + size >= wanted:
                break
            ahead += size
        inside = runs.where(F.col("run") == run).select(*names)
        if least == most or size <= RUN_ROWS:
            break
        wanted -= ahead
    values = most
    if least != most:
        values = inside.orderBy(*names).limit(wanted - ahead).agg(F.max(F.struct(*names))).first()[0]
    edge = F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(inside.dtypes, values, strict=True)])
    key = F.struct(*names)
    less, there = runs.agg(F.count_if(key < edge), F.count_if(key == edge)).first()
    return list(values), wanted - less, there


def _stored(df):
    path = shared_dir(df.sparkSession, "row-keys")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sub_windows(spark, start, end, step):
    """Consecutive half-open ranges of ``step`` covering ``[start, end)``, one row each.

    Rows are spread over the cluster, so a pull job can take one per task.
    """
    if step < 1:
        raise ValueError("step must be >= 1")
    ranges = spark.range(start, end, step)
    return ranges.select(
        F.call_function("div", F.col("id") - start, F.lit(step)).alias("window_no"),
        F.col("id").alias("from"),
        F.least(F.col("id") + step, F.lit(end)).alias("to"),
    )
