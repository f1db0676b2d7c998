"""Log aggregations: counts, cardinalities, measures and percentiles per facet bucket."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from telemere import schemas
from telemere.operators.groups import counted_values, exact_percentile, top_k_per_group
from telemere.operators.lookups import BROADCAST_ROWS, salted_join
from telemere.operators.search import facet

# Percentile computes.
PERCENTILES = {"pc75": 0.75, "pc90": 0.90, "pc95": 0.95, "pc98": 0.98, "pc99": 0.99}
MEASURES = ("sum", "avg", "min", "max")
COMPUTES = ("count", "cardinality", *MEASURES, *PERCENTILES)
MAX_GROUP_LIMIT = 10_000


@dataclass(frozen=True)
class StatsOptions:
    """Checked arguments of a log aggregation."""

    compute: str = "count"
    metric: str | None = None
    group_by: tuple = ()
    group_limit: int = 10
    approx: bool = False
    retries: int = 4
    timeout: int = 60

    def __post_init__(self):
        object.__setattr__(self, "compute", (self.compute or "").lower())
        object.__setattr__(self, "group_by", tuple(self.group_by or ()))
        if not self.compute:
            raise ValueError(f"no compute given; there are {', '.join(COMPUTES)}")
        if self.compute != "count" and not self.metric:
            raise ValueError(f"{self.compute} of what? Name a facet in metric")
        if self.compute not in COMPUTES:
            raise ValueError(f"there is no compute {self.compute!r}; there are {', '.join(COMPUTES)}")
        if any(not isinstance(f, str) or not f for f in self.group_by):
            raise ValueError("group_by holds something that is no facet name")
        if not 1 <= self.group_limit <= MAX_GROUP_LIMIT:
            raise ValueError(f"group_limit is {self.group_limit}; buckets per facet go from 1 to {MAX_GROUP_LIMIT}")
        if self.retries < 0:
            raise ValueError("retries is negative; give 0 to try once")
        if self.timeout < 1:
            raise ValueError("timeout is below one second")


def log_stats(logs, options=None, relation="logs", **arguments):
    """Aggregate a log relation into ``(by, value)`` rows.

    Rows missing a facet are left out of grouped results. Under ``group_limit``
    the first facet keeps its top values by its own aggregate, the next facet its
    top values within each of those, and so on; ties go to the smaller key.
    """
    options = options or StatsOptions(**arguments)
    keys = [f"_f{i}" for i in range(len(options.group_by))]
    columns = [facet(name, relation).alias(key) for name, key in zip(options.group_by, keys)]
    if options.compute != "count":
        metric = facet(options.metric, relation)
        columns.append((metric if options.compute == "cardinality" else metric.try_cast("double")).alias("_m"))
    base = logs.select(*columns) if columns else logs.select(F.lit(1).alias("_one"))
    for key in keys:
        base = base.where(F.col(key).isNotNull())
    aggregate = _aggregator(base, keys, options)

    if not keys:
        return aggregate([]).select(F.lit("{}").alias("by"), F.col("value").cast("double").alias("value"))
    kept = None
    for depth in range(1, len(keys) + 1):
        level = aggregate(keys[:depth], kept, keys[: depth - 1])
        order = [F.desc_nulls_last("value"), F.asc(keys[depth - 1])]
        kept = top_k_per_group(level, keys[: depth - 1], order, options.group_limit, keys[depth - 1 : depth])
    named = [F.col(key).alias(name) for key, name in zip(keys, options.group_by)]
    columns = {"by": F.to_json(F.struct(*named)), "value": F.col("value")}
    return kept.select(*schemas.project(schemas.LOG_STATS, columns))


def _aggregator(base, keys, options):
    """A function giving ``value`` per prefix of the keys, limited to kept prefixes.

    Where the compute allows it the rows are reduced once to the finest buckets
    (or distinct values) with map-side combining, and every level is derived from
    that; the shared shuffle is planned once and reused.
    """
    compute = options.compute
    if compute == "count":
        finest = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else base

        def measure(df, prefix):
            total = F.sum("_n") if keys else F.count(F.lit(1))
            return df.groupBy(*prefix).agg(total.cast("double").alias("value"))

    elif compute == "cardinality":
        finest = base if options.approx else base.where(F.col("_m").isNotNull()).distinct()

        def measure(df, prefix):
            counter = F.approx_count_distinct("_m") if options.approx else F.count_distinct("_m")
            return df.groupBy(*prefix).agg(counter.cast("double").alias("value"))

        if not options.approx and keys:
            # A bucket whose metric is missing everywhere still counts, as zero.
            finest = base.distinct()
    elif compute in MEASURES:
        finest = base.groupBy(*keys).agg(
            F.sum("_m").alias("_sum"),
            F.count("_m").alias("_n"),
            F.min("_m").alias("_min"),
            F.max("_m").alias("_max"),
        )
        total = {
            "sum": F.sum("_sum"),
            "avg": F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0)),
            "min": F.min("_min"),
            "max": F.max("_max"),
        }[compute]

        def measure(df, prefix):
            return df.groupBy(*prefix).agg(total.alias("value"))

    else:
        p = PERCENTILES[compute]
        finest = base if options.approx else counted_values(base, keys, "_m")

        def measure(df, prefix):
            if options.approx:
                return df.groupBy(*prefix).agg(F.percentile_approx("_m", p).alias("value"))
            return exact_percentile(df.select(*prefix, "_m", "_n"), prefix, "_m", p)

    def aggregate(prefix, kept=None, kept_keys=()):
        rows = finest
        if kept is not None:
            chosen = kept.select(*kept_keys)
            # Kept prefixes are unique, so this is a semi join; written as an inner join it stays
            # above the aggregate, whose shuffle all levels then share. Their number is bounded
            # by the limit alone.
            if options.group_limit ** len(kept_keys) <= BROADCAST_ROWS:
                rows = rows.join(F.broadcast(chosen), list(kept_keys))
            else:
                rows = salted_join(rows, chosen, kept_keys, keys)
        return measure(rows, prefix)

    return aggregate


def metric_rollup(metrics, agg="avg", name=None, scope=None, by=(), step_seconds=60):
    """Aggregate metric points per time bucket, metric and tag values.

    ``scope`` maps tag names to wanted values, ``by`` lists tag names to group by.
    Buckets start at multiples of ``step_seconds`` and are named by their start.
    """
    from telemere.functions.otel import tag_value

    functions = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    if agg not in functions:
        raise ValueError(f"agg must be one of {', '.join(functions)}")
    if step_seconds < 1:
        raise ValueError("step_seconds must be >= 1")
    rows = metrics.where(F.col("name") == name) if name else metrics
    tags = F.from_json(F.get_json_object("metric_attributes", "$.tags"), "array<string>")
    for tag, wanted in (scope or {}).items():
        rows = rows.where(tag_value(tags, tag) == wanted)
    width = F.lit(step_seconds * 1_000_000_000).cast("long")
    start = F.col("time_unix_nano") - F.pmod(F.col("time_unix_nano"), width)
    labelled = rows.select(
        start.alias("time_unix_nano"),
        "name",
        *[tag_value(tags, tag).alias(tag) for tag in by],
        "double_value",
    )
    return labelled.groupBy("time_unix_nano", "name", *by).agg(functions[agg]("double_value").alias("value"))
