"""Metric query responses as the 17-column metric relation."""

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.functions.otel import tag_value
from telemere.functions.time import millis_to_nanos
from telemere.sources.pages import guarded

# Tag names a metric column is filled from, first match wins.
SERVICE_TAGS = ("service",)
NAMESPACE_TAGS = ("service.namespace", "service_namespace")
INSTANCE_TAGS = ("service.instance.id", "service_instance_id")
HOST_TAGS = ("host",)


def _first_problem(problems):
    return F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0))


def _point_problem(point):
    pair = J.array_at(point, "$")
    when = J.kind_of(F.get(pair, F.lit(0)))
    value = J.kind_of(F.get(pair, F.lit(1)))
    return (
        F.when(pair.isNull() | (F.size(pair) != 2), F.lit("metric response has a malformed point"))
        .when(~J.is_number_kind(when), F.lit("metric response has a malformed point time"))
        .when(~(J.is_number_kind(value) | (value == "VOID")), F.lit("metric response has a nonnumeric value"))
    )


def _series_problem(series):
    points = J.array_at(series, "$.pointlist")
    return (
        F.when(
            F.coalesce(J.string_at(series, "$.metric"), F.lit("")) == "",
            F.lit("metric response has a series without a metric name"),
        )
        .when(points.isNull(), F.lit("metric response has a malformed pointlist"))
        .otherwise(_first_problem(F.transform(points, _point_problem)))
    )


def response_problem(doc):
    """Why a metric response is malformed; NULL when it is sound."""
    series = J.array_at(doc, "$.series")
    return (
        F.when(doc.isNull(), F.lit("metric response is not valid JSON"))
        .when(series.isNull(), F.lit("metric response has no series array"))
        .otherwise(_first_problem(F.transform(series, _series_problem)))
    )


def _unit(holder):
    name = F.nullif(J.string_at(holder, "$.unit[0].short_name"), F.lit(""))
    return F.coalesce(name, F.nullif(J.string_at(holder, "$.unit[0].name"), F.lit("")))


def normalise_metrics(
    responses, provider, site, carry=(), include_series=False, on_malformed="raise"
):
    """One row per non-null point of every series of every response.

    ``provider`` and ``site`` fill the ``<provider>.site`` resource attribute. The
    unit is the response's own, else the series'. ``include_series`` repeats the
    whole series in every row's attributes, which is quadratic in its points and
    therefore off by default.
    """
    parsed = responses.select(*carry, J.parse_whole(F.col("body")).alias("doc"))
    series = parsed.select(
        *carry,
        _unit(F.col("doc")).alias("unit"),
        F.explode(
            guarded(J.array_at(F.col("doc"), "$.series"), response_problem(F.col("doc")), on_malformed)
        ).alias("series"),
    )
    tags = F.coalesce(J.node(F.col("series"), "$.tag_set"), J.parse(F.lit("[]")))
    per_series = series.select(
        *carry,
        F.coalesce("unit", _unit(F.col("series"))).alias("unit"),
        J.string_at(F.col("series"), "$.metric").alias("metric"),
        F.coalesce(J.string_at(F.col("series"), "$.scope"), F.lit("")).alias("scope"),
        tags.alias("tags"),
        J.string_elements(J.array_at(F.col("series"), "$.tag_set")).alias("tag_list"),
        *([F.col("series")] if include_series else []),
        F.try_variant_get("series", "$.pointlist", "array<array<variant>>").alias("points"),
    )
    # Per-series columns are settled before the points multiply the rows.
    held = [F.col("tags"), F.col("scope"), F.col("metric")]
    if include_series:
        held.append(F.col("series"))
    settled = per_series.select(
        *carry,
        "metric",
        "unit",
        tag_value(F.col("tag_list"), *SERVICE_TAGS).alias("service_name"),
        tag_value(F.col("tag_list"), *NAMESPACE_TAGS).alias("service_namespace"),
        tag_value(F.col("tag_list"), *INSTANCE_TAGS).alias("service_instance_id"),
        J.ordered_object(
            (f"{provider}.site", F.lit(site)), ("host", tag_value(F.col("tag_list"), *HOST_TAGS))
        ).alias("resource_attributes"),
        F.to_json(F.struct(*held, "unit")).alias("metric_attributes"),
        F.explode("points").alias("point"),
    )
    value = F.get("point", F.lit(1))
    points = settled.where(J.kind_of(value) != "VOID")
    columns = {
        "time_unix_nano": millis_to_nanos(F.try_variant_get(F.get("point", F.lit(0)), "$", "decimal(30,9)")),
        "name": F.col("metric"),
        "unit": F.col("unit"),
        "double_value": F.try_variant_get(value, "$", "double"),
        **{
            name: F.col(name)
            for name in (
                "service_name",
                "service_namespace",
                "service_instance_id",
                "resource_attributes",
                "metric_attributes",
            )
        },
    }
    return points.select(*carry, *schemas.project(schemas.METRICS, columns))


def metric_rejects(responses, keep=("scan_id",)):
    """The malformed responses and why."""
    parsed = responses.select(*keep, J.parse_whole(F.col("body")).alias("doc"))
    return parsed.select(*keep, response_problem(F.col("doc")).alias("reason")).where("reason is not null")
