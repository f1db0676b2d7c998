"""Raw landing pages: one row per response body, plus what a reader needs to order them.

``scan_id`` names one paged read, ``page_no`` counts its pages from 0, ``cursor``
is the cursor the page was asked for with, ``body`` the response text. Landing
tables may add ``index`` and ``dt`` as partition columns, and ``after`` and
``n_rows`` (see :func:`with_page_header`) so that paging never reads bodies, and
``first_nanos`` and ``last_nanos`` (see :func:`with_page_times`) so that windows skip pages.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemere.functions import json as J
from telemere.functions import otel
from telemere.functions.time import iso_to_nanos

LANDING = T.StructType(
    [
        T.StructField("scan_id", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

ON_MALFORMED = ("raise", "skip")


def check_policy(on_malformed):
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")


def guarded(items, problem, on_malformed):
    """``items`` to explode: nothing, or an error, when ``problem`` is not NULL.

    Guarding the generator's input rather than filtering keeps the parsed document
    in one projection; a filter would be pushed below it and parse again.
    """
    check_policy(on_malformed)
    sound = F.when(problem.isNull(), items)
    if on_malformed == "skip":
        return sound
    return sound.otherwise(F.raise_error(problem))


def _is_broken(corrupt):
    """Whether a body is no JSON, given what a typed parse could not take of it."""
    body = F.col("body")
    # Only a page the typed parse could not take is parsed again, to tell wrong shape from no JSON.
    broken = corrupt.isNotNull() & J.parse(body).isNull()
    # Trimming goes through a body sign by sign, so its end is looked at first.
    closed = body.endswith("}") | body.endswith("]")
    return broken | (~closed & ~F.right(otel.trim_blanks(body), F.lit(1)).isin("}", "]"))


def explode_events(pages, carry=(), on_malformed="raise"):
    """One row per ``data[]`` element: the carried columns and ``event`` = (text, doc).

    A page whose ``data`` is missing or not an array has no events; a page that is
    not JSON at all is malformed. The element is parsed once, inside the generator,
    so neither pushed-down filters nor the projection above parse it again.
    """
    check_policy(on_malformed)
    fields = F.from_json(
        "body", "data array<string>, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", **J.STRICT}
    )
    parsed = F.transform(
        F.col("page.data"), lambda t: F.struct(t.alias("text"), J.parse(t).alias("doc"))
    )
    problem = F.when(_is_broken(F.col("page._corrupt")), F.lit("response page is not valid JSON"))
    return pages.select(*carry, "body", fields.alias("page")).select(
        *carry, F.explode(guarded(parsed, problem, on_malformed)).alias("event")
    )


def _typed(shape):
    """DDL of the fields of a shape: VARIANTs by name, and objects with a shape of their own."""
    return ", ".join(f"{n}:variant" if inner is None else f"{n}:struct<{_typed(inner)}>" for n, inner in shape.items())


def _held(doc, shape):
    """What a typed parse gives for the fields of a shape, taken from the object's VARIANT."""
    found = {n: J.node(doc, f"$.{n}") for n in shape}
    return F.struct(
        *[
            (found[n] if inner is None else F.when(J.is_object(found[n]), _held(found[n], inner))).alias(n)
            for n, inner in shape.items()
        ]
    )


def explode_attributes(pages, shape, source, carry=(), on_malformed="raise"):
    """One row per ``data[]`` element: the carried columns and ``event`` = (``of``, ``text``).

    ``of`` has the fields of a shape out of the element's ``attributes`` and is NULL where it has none: a field is a VARIANT or, with
    a shape of its own, a struct that is NULL for anything but an object. Looking up a path that a VARIANT does not have is dear.
    ``text.<source>`` is the source text of the field ``source``. Two typed parses of a page take them straight
    from the body. Only where a page holds other shapes (an element, ``attributes`` or a field with a shape that is no object) are
    its elements parsed one by one. Malformed pages are those of :func:`explode_events`.
    """
    check_policy(on_malformed)
    fields = "data array<struct<attributes:struct<{}>>>"
    corrupt = {"columnNameOfCorruptRecord": "_corrupt", **J.STRICT}
    typed = F.from_json("body", fields.format(_typed(shape)) + ", _corrupt string", corrupt)
    texts = F.from_json("body", fields.format(f"{source}:string"), J.STRICT)
    quick = F.arrays_zip(
        F.col("page.data")["attributes"].alias("of"), F.col("texts.data")["attributes"].alias("text")
    )

    def one_by_one(event):
        attributes = J.node(event["doc"], "$.attributes")
        return F.struct(
            F.when(attributes.isNotNull(), _held(attributes, shape)).alias("of"),
            F.struct(F.get_json_object(event["text"], f"$.attributes.{source}").alias(source)).alias("text"),
        )

    elements = F.from_json("body", "data array<string>", J.STRICT)["data"]
    parsed = F.transform(elements, lambda t: F.struct(t.alias("text"), J.parse(t).alias("doc")))
    # An ``attributes`` that is null is there, which a typed parse does not tell.
    all_there = F.size(F.array_compact(F.col("page.data")["attributes"])) == F.size("page.data")
    null_there = ~F.coalesce(all_there, F.lit(False)) & F.col("body").rlike(r'"attributes"\s*:\s*null')
    plain = F.col("page._corrupt").isNull() & ~null_there
    items = F.when(plain, quick).otherwise(F.transform(parsed, one_by_one))
    broken = _is_broken(F.col("page._corrupt"))
    problem = F.when(broken, F.lit("response page is not valid JSON"))
    return pages.select(*carry, "body", typed.alias("page"), texts.alias("texts")).select(
        *carry, F.explode(guarded(items, problem, on_malformed)).alias("event")
    )


def with_page_header(pages):
    """Add ``after`` (next cursor, strict string) and ``n_rows`` (events in the page, NULL if it is no JSON).

    Write landing tables through this once: paging then reads two narrow columns.
    """
    missing = {
        "after": J.string_at(J.parse(F.get_json_object("body", "$.meta.page")), "$.after"),
        "n_rows": F.when(
            F.get_json_object("body", "$").isNotNull(),
            F.coalesce(F.json_array_length(F.get_json_object("body", "$.data")), F.lit(0)),
        ).cast("long"),
    }
    return pages.select(
        "*", *[column.alias(name) for name, column in missing.items() if name not in pages.columns]
    )


def with_page_times(pages):
    """Add ``first_nanos`` and ``last_nanos``, the times of a page's earliest and latest event.

    Both are NULL for a page without timed events or that is no JSON, which every window reads.
    """
    if "first_nanos" in pages.columns:
        return pages
    events = F.from_json("body", "data array<struct<attributes:struct<timestamp:string,start_timestamp:string>>>")
    times = F.transform(
        events["data"]["attributes"], lambda a: iso_to_nanos(F.coalesce(a["timestamp"], a["start_timestamp"]))
    )
    timed = pages.withColumn("_times", times)
    return timed.select("*", F.array_min("_times").alias("first_nanos"), F.array_max("_times").alias("last_nanos")).drop("_times")
