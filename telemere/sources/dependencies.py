"""Service-dependency objects as directed edges in the 17-column edge relation."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.sources.pages import guarded

_EPOCH = datetime(1970, 1, 1)


def response_problem(doc):
    """Why a dependency object is malformed; NULL when it is sound."""
    services = F.try_variant_get(doc, "$", J.VARIANT_MAP)

    def bad_service(_, value):
        calls = J.array_at(value, "$.calls")
        return (
            ~F.coalesce(J.is_object(value), F.lit(False))
            | calls.isNull()
            | F.exists(calls, lambda c: J.kind_of(c) != "STRING")
        )

    return (
        F.when(doc.isNull(), F.lit("dependency response is not valid JSON"))
        .when(~J.is_object(doc), F.lit("dependency response is not an object"))
        .when(
            F.size(F.map_filter(services, bad_service)) > 0,
            F.lit("dependency response has a service without a calls array of strings"),
        )
    )


def edges_of(responses, carry=(), on_malformed="raise"):
    """Distinct edges of each response with their first-seen positions.

    An object's keys are unique, so dropping repeats within one ``calls`` array is
    enough: no shuffle.
    """
    parsed = responses.select(*carry, "body", J.parse_whole(F.col("body")).alias("doc"))
    sound = guarded(J.typed_map(F.col("body")), response_problem(F.col("doc")), on_malformed)
    services = parsed.select(*carry, F.posexplode(sound).alias("service_pos", "source_service", "value"))
    calls = F.array_distinct(F.try_variant_get("value", "$.calls", "array<string>"))
    return services.select(
        *carry, "source_service", "service_pos", F.posexplode(calls).alias("call_pos", "target_service")
    )


def _moment(seconds):
    return F.lit(_EPOCH + timedelta(seconds=seconds)).cast("timestamp_ntz")


def normalise_dependencies(responses, provider, environment, window, on_malformed="raise"):
    """Distinct directed edges over all responses of one environment and window.

    ``window`` is a :class:`telemere.functions.window.Window` in seconds. The
    source gives topology only, so types, statistics and attributes are NULL.
    """
    edges = edges_of(responses, (), on_malformed).select("source_service", "target_service").distinct()
    columns = {
        "provider": F.lit(provider),
        "source_service": F.col("source_service"),
        "target_service": F.col("target_service"),
        "environment": F.lit(environment),
        "window_start": _moment(window.start),
        "window_end": _moment(window.end),
    }
    return edges.select(*schemas.project(schemas.DEPENDENCIES, columns))


def dependency_rejects(responses, keep=("scan_id",)):
    """The malformed responses and why."""
    parsed = responses.select(*keep, J.parse_whole(F.col("body")).alias("doc"))
    return parsed.select(*keep, response_problem(F.col("doc")).alias("reason")).where("reason is not null")
