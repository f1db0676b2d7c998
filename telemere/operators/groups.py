"""Per-group operations that hold up when one group has a large share of the rows."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Shares a group is cut into before its final top-k.
TOP_K_SHARES = 32
# Shares a group's values are dealt to, bins of a histogram, and histograms behind the first one.
VALUE_SHARES = 16
BINS = 1 << 17
ROUNDS = 3


def top_k_per_group(df, keys, order, k, spread):
    """First ``k`` rows of every group by ``order``.

    Groups are first cut into shares by a hash of ``spread`` and each share is
    reduced to ``k`` rows, so the final ranking of a group sees a bounded number.
    """
    if not keys:
        return df.orderBy(*order).limit(k)
    share = F.pmod(F.xxhash64(*spread), F.lit(TOP_K_SHARES))
    first = df.withColumn("_share", share)
    first = first.withColumn("_rank", F.row_number().over(W.partitionBy(*keys, "_share").orderBy(*order)))
    first = first.where(F.col("_rank") <= k).drop("_share", "_rank")
    ranked = first.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def counted_values(df, keys, value, count="_n"):
    """Each distinct value of a group with its number of rows; a missing value counts none."""
    return df.groupBy(*keys, value).agg(F.count(value).alias(count))


def exact_percentile(counted, keys, value, p, count="_n"):
    """Exact interpolated percentile of a double column per group, as ``value``.

    ``counted`` has the keys, distinct values and their counts (see :func:`counted_values`). The wanted
    ranks are found by histograms: count per bin, keep the bin that holds the rank, repeat. The first
    bins are sixteenths of a power of two, the next ones even parts between a bin's least and
    greatest value; those have at most 2 ** 49 doubles between them, so ``ROUNDS`` rounds of
    ``BINS`` leave one. What is sorted for a group is never more than ``BINS`` counts, two for each rank.

    Values are dealt to tasks by shares of a group, once for all rounds. Nothing runs until
    the result is read. A group without values has a NULL percentile.
    """
    rows = counted.withColumns({"_share": F.pmod(F.xxhash64(value), F.lit(VALUE_SHARES)).cast("int"), "_v": F.col(value)})
    rows = rows.select(*keys, "_share", "_v", F.col(count).alias("_n"))
    bins = _histogram(rows, keys, _magnitude(F.col("_v")))
    total = F.sum("_n").over(W.partitionBy(*keys))
    bins = bins.withColumns({"_total": total, "_upto": F.sum("_n").over(_running(keys))})
    wanted = (F.col("_total") - 1) * F.lit(p)
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("_t"), at.alias("_rank")) for i, at in enumerate((F.floor(wanted), F.ceil(wanted)))]))
    state = (
        bins.where("_total > 0")
        .select("*", (wanted - F.floor(wanted)).alias("_between"), ranks.alias("_r"))
        .select("*", "_r.*")
        .where("_upto - _n <= _rank and _rank < _upto")
        .select(*keys, "_t", "_rank", "_between", (F.col("_upto") - F.col("_n")).alias("_below"), "_low", "_high")
    )
    for _ in range(ROUNDS):
        state = _refined(rows, state, keys)
    held = state.select(*keys, "_t", "_between", "_low")
    held = held.unionByName(bins.where("_total = 0").select(*keys), allowMissingColumns=True)
    low, high = (F.max(F.when(F.col("_t") == i, F.col("_low"))) for i in (0, 1))
    return held.groupBy(*keys).agg((low + F.max("_between") * (high - low)).alias("value"))


def _magnitude(v):
    """Bin of a double by sign and sixteenth of a power of two; never decreasing in ``v``."""
    steps = F.least(F.floor(F.log2(F.abs(v)) * 16), F.lit(20_000)) + 100_000
    # NaN sorts behind all numbers.
    return F.when(F.isnan(v), F.lit(200_000)).when(v == 0, F.lit(0)).when(v > 0, steps).when(v < 0, -steps).cast("int")


def _histogram(rows, keys, bin_, *kept):
    return rows.groupBy(*keys, bin_.alias("_bin")).agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *kept
    )


def _running(keys):
    return W.partitionBy(*keys).orderBy(F.asc_nulls_first("_bin")).rowsBetween(W.unboundedPreceding, 0)


def _refined(rows, state, keys):
    """The state of each rank after one more histogram of the values in its bin."""
    # Values of a large group meet its state in several tasks.
    copies = state.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(VALUE_SHARES - 1))))
    copies = copies.withColumnsRenamed({"_low": "_from", "_high": "_to"})
    inside = rows.join(copies, [*keys, "_share"]).where("_v >= _from and _v <= _to")
    width = F.col("_to") - F.col("_from")
    part = F.when(F.col("_from") == F.col("_to"), F.lit(0)).otherwise(F.floor((F.col("_v") - F.col("_from")) / width * BINS))
    held = ("_rank", "_between", "_below")
    bins = _histogram(inside, [*keys, "_t"], part.cast("int"), *[F.max(c).alias(c) for c in held])
    bins = bins.withColumn("_upto", F.col("_below") + F.sum("_n").over(_running([*keys, "_t"])))
    found = bins.where("_upto - _n <= _rank and _rank < _upto")
    return found.select(
        *keys, "_t", "_rank", "_between", (F.col("_upto") - F.col("_n")).alias("_below"), "_low", "_high"
    )
