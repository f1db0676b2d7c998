"""Aggregation responses as (by, value) rows, and index-list responses as names."""

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.sources.pages import guarded


def aggregate_problem(doc):
    """Why an aggregation response is malformed; NULL when it is sound or simply empty."""
    buckets = J.array_at(doc, "$.data.buckets")
    return F.when(doc.isNull(), F.lit("aggregation response is not valid JSON")).when(
        F.exists(buckets, lambda b: ~J.is_object(b)), F.lit("aggregation response has a malformed bucket")
    )


def normalise_aggregates(responses, carry=(), on_malformed="raise"):
    """One row per bucket: ``by`` as JSON object text and the first compute as a double.

    A response without buckets has no rows; a bucket without ``by`` is the total ``{}``.
    """
    parsed = responses.select(*carry, "body", J.parse_whole(F.col("body")).alias("doc"))
    texts = F.from_json(F.get_json_object("body", "$.data.buckets"), "array<string>", J.STRICT)
    entries = F.transform(texts, lambda t: F.struct(t.alias("text"), J.parse(t).alias("doc")))
    sound = guarded(entries, aggregate_problem(F.col("doc")), on_malformed)
    buckets = parsed.select(*carry, F.explode(sound).alias("bucket"))
    doc, text = F.col("bucket.doc"), F.col("bucket.text")
    computes = F.map_values(J.typed_map(J.object_text(doc, text, "$.computes")))
    first = F.get(computes, F.lit(0))
    columns = {
        "by": F.coalesce(J.object_text(doc, text, "$.by"), F.lit("{}")),
        "value": F.when(J.is_number(first), F.try_variant_get(first, "$", "double")),
    }
    return buckets.select(*carry, *schemas.project(schemas.LOG_STATS, columns))


def index_problem(doc):
    """Why an index list is malformed; NULL when it is sound."""
    entries = J.array_at(doc, "$.indexes")
    nameless = F.exists(entries, lambda e: F.coalesce(J.string_at(e, "$.name"), F.lit("")) == "")
    return (
        F.when(doc.isNull(), F.lit("index list is not valid JSON"))
        .when(entries.isNull(), F.lit("index list has no indexes array"))
        .when(nameless, F.lit("index names must be non-empty strings"))
    )


def normalise_indexes(responses, carry=(), on_malformed="raise"):
    """Distinct index names with their first position, to be ordered by it."""
    parsed = responses.select(*carry, J.parse_whole(F.col("body")).alias("doc"))
    sound = guarded(J.array_at(F.col("doc"), "$.indexes"), index_problem(F.col("doc")), on_malformed)
    entries = parsed.select(*carry, F.posexplode(sound).alias("position", "entry"))
    names = entries.select(*carry, J.string_at(F.col("entry"), "$.name").alias("name"), "position")
    return names.groupBy(*carry, "name").agg(F.min("position").alias("position"))
