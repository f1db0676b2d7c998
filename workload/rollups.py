"""Registered queries over merged rollups, and what malformed responses are rejected for."""

from pyspark.sql import functions as F

from telemere.operators import rollups
from telemere.session import shared_dir
from telemere.sources import alerts, dependencies, metrics
from workload import fixtures as fx
from workload import relations_sql as R
from workload.queries import PROVIDER, SITE, logs, query, with_logs

_DAY = "time_unix_nano // 86400000000000 * 86400000000000"


def _rolled(spark, sf):
    """Five-minute sketches of all logs, written and read again as a rollup table would be."""
    path = shared_dir(spark, "rollup")
    rollups.sketch_rollup(logs(spark, sf), 300, ("service", "status"), "@duration_ns", "@k").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "rollup_days",
    with_logs(
        f"""SELECT {_DAY} AS window_start, service_name AS service, count(*) AS n, CAST(sum(duration_ns) AS DOUBLE) AS sum,
              CAST(min(duration_ns) AS DOUBLE) AS min, CAST(max(duration_ns) AS DOUBLE) AS max
            FROM logs WHERE service_name IS NOT NULL GROUP BY 1, 2"""
    ),
)
def _(spark, sf):
    days = rollups.merge_rollup(_rolled(spark, sf), 86_400, ("service",))
    return days.select("window_start", "service", "n", "sum", "min", "max")


@query(
    "rollup_sketches",
    with_logs(
        """SELECT service_name AS service, true AS cardinality_fits, true AS pc75_fits, true AS pc95_fits, true AS pc99_fits
           FROM logs WHERE service_name IS NOT NULL GROUP BY 1"""
    ),
)
def _(spark, sf):
    """Cardinality within 5 %; of a percentile, the share of values below it within 2 % of what it should be."""
    rows = logs(spark, sf)
    merged = rollups.rollup_values(rollups.merge_rollup(_rolled(spark, sf), group_by=("service",)))
    value = F.get_json_object("log_attributes", "$.duration_ns").cast("double")
    exact = rows.select(
        F.col("service_name").alias("service"), value.alias("value"), F.get_json_object("log_attributes", "$.k").alias("k")
    )
    names = {"pc75": 0.75, "pc95": 0.95, "pc99": 0.99}
    met = exact.join(merged.select("service", "cardinality", *names), "service")
    shares = [F.avg((F.col("value") <= F.col(n)).cast("double")).alias(f"_{n}") for n in names]
    checked = met.groupBy("service").agg(F.count_distinct("k").alias("_k"), F.max("cardinality").alias("cardinality"), F.count(F.lit(1)).alias("_n"), *shares)
    # A step of one value is allowed for besides.
    fits = [(F.abs(F.col(f"_{n}") - p) <= 0.02 + 1 / F.col("_n")).alias(f"{n}_fits") for n, p in names.items()]
    return checked.select("service", (F.abs(F.col("cardinality") - F.col("_k")) <= 0.05 * F.col("_k")).alias("cardinality_fits"), *fits)


@query(
    "metric_instances",
    f"WITH {R.METRICS} SELECT time_unix_nano, service_name, 'i-' || service_name AS service_instance_id FROM metrics",
)
def _(spark, sf):
    tagged = F.regexp_replace("body", '"service:([a-z]+)"', '"service:$1","service.instance.id:i-$1"')
    points = metrics.normalise_metrics(fx.metric_responses(spark, sf).withColumn("body", tagged), PROVIDER, SITE)
    return points.select("time_unix_nano", "service_name", "service_instance_id")


def _cases(number, bodies):
    """A body for each number from 1 that stands for a fault; the sound body for any other."""
    return f"case {number} " + " ".join(f"when {i} then {b}" for i, b in enumerate(bodies, 1)) + " else body end as body"


def _reasons(number, reasons):
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(reasons, 1)) + " END AS reason"


_METRIC = ["is not valid JSON", "has no series array", "has a series without a metric name", "has a malformed point"]


@query(
    "metric_rejects",
    f"""SELECT CAST(day AS VARCHAR) AS scan_id, {_reasons("day(day) % 5", [f"metric response {r}" for r in _METRIC])}
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) WHERE day(day) % 5 > 0""",
)
def _(spark, sf):
    bodies = ["concat(body, '}')", """'{"other":1}'""", """'{"series":[{"pointlist":[]}]}'""", """'{"series":[{"metric":"m","pointlist":[[1]]}]}'"""]
    broken = fx.metric_responses(spark, sf).selectExpr("scan_id", _cases("dayofmonth(cast(scan_id as date)) % 5", bodies))
    return metrics.metric_rejects(broken)


_ALERT = [
    "alert page is not valid JSON", "alert page has no groups array", "alert page total_count must be a non-negative integer",
    "alert group tags must be strings",
]


@query(
    "alert_rejects",
    f"""SELECT scan_id, page_no, {_reasons("(page_no + length(scan_id)) % 5", _ALERT)}
        FROM (SELECT DISTINCT event_type AS scan_id, user_id // 100 AS page_no FROM events) WHERE (page_no + length(scan_id)) % 5 > 0""",
)
def _(spark, sf):
    bodies = ["'x'", "'{}'", """'{"groups":[],"metadata":{"total_count":-1}}'""", """'{"groups":[{"group_tags":[1]}]}'"""]
    broken = fx.alert_pages(spark, sf).selectExpr("scan_id", "page_no", _cases("(page_no + length(scan_id)) % 5", bodies))
    return alerts.alert_rejects(broken)


_EDGES = ["is not an object", "has a service without a calls array of strings", "is not valid JSON"]


@query(
    "dependency_rejects",
    f"""SELECT CAST(n_regionkey AS VARCHAR) AS scan_id, {_reasons("n_regionkey", [f"dependency response {r}" for r in _EDGES])}
        FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey BETWEEN 1 AND 3 GROUP BY n_regionkey""",
)
def _(spark, sf):
    bodies = ["'[]'", """'{"a":{"calls":"b"}}'""", "'{'"]
    broken = fx.dependency_responses(spark, sf).selectExpr("scan_id", _cases("cast(scan_id as int)", bodies))
    return dependencies.dependency_rejects(broken)
