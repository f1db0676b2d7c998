"""Strict JSON access as column expressions.

A JSON field counts only when it has the right JSON type, so types are tested on
a parsed VARIANT while text is copied from the JSON source: a VARIANT sorts
object keys, the source keeps them. Everything stays JVM-side.

``doc`` below always means a VARIANT column, ``text`` a JSON text column.
"""

from pyspark.sql import functions as F

VARIANT_MAP = "map<string,variant>"
# Spark's typed JSON reader is lenient by default; the VARIANT parser is not.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse(text):
    """VARIANT of JSON text; NULL when it does not start with a valid JSON value.

    What follows that value is not looked at: use :func:`wrap` and :func:`unwrap`
    where it matters.
    """
    return F.try_parse_json(text)


def wrap(text):
    """VARIANT of ``[text]``: content after the first value of ``text`` makes it NULL or longer."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def unwrap(wrapped, text):
    """The one object or array that is the whole of ``text``; NULL for anything else.

    Text could only hide content by closing the wrapping bracket itself, right
    after its value. Text with such a place is parsed again inside an object,
    where a stray bracket is an error.
    """
    first = F.try_variant_get(wrapped, "$[0]", "variant")
    closes = F.when(is_object(first), text.rlike(r"\}\s*\]")).otherwise(text.rlike(r"\]\s*\]"))
    inside = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = (F.size(array_at(wrapped, "$")) == 1) & (~closes | inside.isNotNull())
    return F.when(alone, first)


def parse_whole(text):
    """VARIANT of text that is one JSON value and nothing else."""
    return unwrap(wrap(text), text)


def node(doc, path):
    return F.try_variant_get(doc, path, "variant")


def kind_of(doc):
    """JSON type name: STRING, BOOLEAN, VOID, BIGINT, DECIMAL(p,s), DOUBLE, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(doc)


def kind(doc, path):
    return kind_of(node(doc, path))


def string_at(doc, path):
    """The string at ``path``; NULL for any other JSON type."""
    return F.when(kind(doc, path) == "STRING", F.try_variant_get(doc, path, "string"))


def as_string(doc):
    return F.when(kind_of(doc) == "STRING", F.try_variant_get(doc, "$", "string"))


def as_number(doc, kind=None):
    """The number as a double; NULL for any other JSON type. ``kind`` is its type's name, where that is known."""
    name = kind_of(doc) if kind is None else kind
    # A whole number read as one is not cast by an expression made for each row.
    whole = F.try_variant_get(doc, "$", "long").cast("double")
    return F.when(name == "BIGINT", whole).when(is_number_kind(name), F.try_variant_get(doc, "$", "double"))


def is_number_kind(name):
    return name.isin("BIGINT", "DOUBLE", "FLOAT") | name.startswith("DECIMAL")


def is_number(doc):
    return is_number_kind(kind_of(doc))


def is_object(doc):
    """Cheaper than naming the type: a schema walks the whole value, this only its keys."""
    return F.try_variant_get(doc, "$", VARIANT_MAP).isNotNull()


def number_at(doc, path, to="double"):
    """The number at ``path`` cast to ``to``; NULL for any other JSON type."""
    return F.when(is_number_kind(kind(doc, path)), F.try_variant_get(doc, path, to))


def object_text(doc, text, path):
    """Source text of the object at ``path``, keys in source order; NULL if not an object."""
    found = F.try_variant_get(doc, path, VARIANT_MAP).isNotNull()
    return F.when(found, F.get_json_object(text, path))


def array_at(doc, path):
    """Elements of the array at ``path`` as VARIANTs; NULL if not an array."""
    return F.try_variant_get(doc, path, "array<variant>")


def non_empty_array_at(doc, path):
    """The array at ``path`` as one VARIANT; NULL if missing, empty or not an array."""
    return F.when(F.size(array_at(doc, path)) > 0, node(doc, path))


def string_elements(elements):
    """The strings among VARIANT elements, in order; other types are skipped."""
    return F.transform(
        F.filter(elements, lambda e: kind_of(e) == "STRING"),
        lambda e: F.try_variant_get(e, "$", "string"),
    )


def typed_map(text):
    """Top-level keys of an object in source order with typed values; NULL if not an object."""
    return F.from_json(_object_like(text), VARIANT_MAP, STRICT)


def text_map(text):
    """Top-level keys with values as text: nested values keep their source text."""
    return F.from_json(_object_like(text), "map<string,string>", STRICT)


def first_of_repeated(entries):
    """A parsed map (see :func:`typed_map`) with the first value of each key that the text repeats."""

    def once(held):
        keys = F.map_keys(held)
        unique = F.array_distinct(keys)
        firsts = F.map_from_arrays(unique, F.transform(unique, lambda k: F.element_at(held, k)))
        return F.when(F.size(unique) < F.size(keys), firsts).otherwise(held)

    # Bound by a lambda, so that the text is parsed once.
    return F.get(F.transform(F.array(entries), once), F.lit(0))


def _object_like(text):
    # Most text has no blanks around it, which is seen without a regular expression.
    return F.when((text.startswith("{") & text.endswith("}")) | text.rlike(r"(?s)^\s*\{.*\}\s*$"), text)


def ordered_object(*fields):
    """JSON object from ``(name, column)`` pairs in that order.

    NULL fields are left out, and the result is NULL when all of them are.
    """
    packed = F.to_json(F.named_struct(*[part for name, column in fields for part in (F.lit(name), column)]))
    present = F.coalesce(*[F.when(column.isNotNull(), F.lit(True)) for _, column in fields])
    return F.when(present, packed)


def members(object_text):
    """Members of JSON object text without its braces; NULL for none."""
    inside = F.substring(object_text, F.lit(2), F.length(object_text) - 2)
    return F.when(object_text.startswith("{") & object_text.endswith("}") & (object_text != "{}"), inside)


def object_of(*member_texts):
    """JSON object text from member texts (see :func:`members`), NULL ones left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *member_texts), F.lit("}"))


def merge_first_wins(*maps):
    """Union of maps where an earlier map's key is never overwritten by a later one.

    Give plain columns: each map is looked up once per key of the later maps.
    """
    kept = [maps[0]]
    for n, later in enumerate(maps[1:], 1):
        kept.append(_without_keys_of(maps[:n], later))
    return F.map_concat(*kept)


def _without_keys_of(earlier, later):
    def unclaimed(key, _):
        test = ~F.map_contains_key(earlier[0], key)
        for held in earlier[1:]:
            test = test & ~F.map_contains_key(held, key)
        return test

    return F.map_filter(later, unclaimed)
