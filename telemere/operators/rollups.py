"""Rollups of logs that merge: counts, sums and sketches per window and facets.

A rollup is computed once per short window and written; any longer window that is a multiple of it, and
any choice of its facets, is answered from the rollup alone. Cardinalities come from HyperLogLog sketches and
percentiles from KLL sketches, whose size does not depend on how much they have seen.
"""

from pyspark.sql import functions as F

from telemere.operators.search import facet
from telemere.operators.stats import PERCENTILES

NANOS = 1_000_000_000
# Sketch sizes: a relative standard error near 0.8 % for cardinalities, a rank error near 1 % for percentiles.
HLL_LG_K, KLL_K = 14, 400


def _start(time, width_s):
    width = F.lit(width_s * NANOS).cast("long")
    return time - F.pmod(time, width)


def sketch_rollup(logs, width_s=300, group_by=(), metric=None, distinct=None, time="time_unix_nano"):
    """One row per window of ``width_s`` seconds and facets: ``window_start``, the facets, ``n`` and what was asked for.

    ``metric`` adds ``n_values``, ``sum``, ``min``, ``max`` and the sketch ``quantiles`` of a numeric facet;
    ``distinct`` adds the sketch ``uniques`` of a facet's values. Rows without a time or a facet are left
    out. Partial sketches combine before the shuffle, so a facet that dominates stays one row per task and window.
    """
    columns = [_start(F.col(time), width_s).alias("window_start"), *[facet(name).alias(name) for name in group_by]]
    if metric:
        columns.append(facet(metric).try_cast("double").alias("_metric"))
    if distinct:
        columns.append(facet(distinct).cast("string").alias("_distinct"))
    rows = logs.select(*columns)
    for name in ("window_start", *group_by):
        rows = rows.where(F.col(f"`{name}`").isNotNull())
    measures = [F.count(F.lit(1)).alias("n")]
    if metric:
        value = F.col("_metric")
        measures += [
            F.count(value).alias("n_values"), F.sum(value).alias("sum"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.kll_sketch_agg_double(value, KLL_K).alias("quantiles"),
        ]
    if distinct:
        measures.append(F.hll_sketch_agg("_distinct", HLL_LG_K).alias("uniques"))
    return rows.groupBy("window_start", *[F.col(f"`{g}`") for g in group_by]).agg(*measures)


def merge_rollup(rollup, width_s=None, group_by=()):
    """A rollup of longer windows, or of all time without ``width_s``, and of some of the facets."""
    start = [_start(F.col("window_start"), width_s).alias("window_start")] if width_s else []
    measures = [F.sum("n").alias("n")]
    if "quantiles" in rollup.columns:
        measures += [
            F.sum("n_values").alias("n_values"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
            F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"),
        ]
    if "uniques" in rollup.columns:
        measures.append(F.hll_union_agg("uniques").alias("uniques"))
    return rollup.groupBy(*start, *[F.col(f"`{g}`") for g in group_by]).agg(*measures)


def rollup_values(rollup):
    """A rollup with its sketches read out: ``cardinality``, and a column for each percentile compute; NULL without values."""
    out = rollup
    if "uniques" in rollup.columns:
        out = out.withColumn("cardinality", F.hll_sketch_estimate("uniques")).drop("uniques")
    if "quantiles" in rollup.columns:
        held = F.col("n_values") > 0
        for name, p in PERCENTILES.items():
            out = out.withColumn(name, F.when(held, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))))
        out = out.withColumn("avg", F.col("sum") / F.nullif(F.col("n_values"), F.lit(0))).drop("quantiles")
    return out
