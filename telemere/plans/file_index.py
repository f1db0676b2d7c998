"""Which files of a landing table hold what: an index by term, so that a search opens few files.

A term is a facet's value or three neighbouring characters of an event's message (for spans, of its name),
as a hash of eight bytes. :func:`index_landed` adds the files of a table that the index does not have yet::

    <kind>_index/terms/   term, file     once for each term of a file, in the order of terms
    <kind>_index/files/   file, whole    the files indexed; ``whole``: all their pages can be parsed

A text of three characters or more occurs only where all its threes do, so the index never misses
a match; rows are tested as ever. Files that are not indexed, or hold a page that cannot be parsed, are always
read. Terms are found where the files are and shuffle once; a search reads the row groups of its terms.
"""

import re
from urllib.parse import unquote

from pyspark.sql import functions as F

from telemere.functions import otel
from telemere.operators.search import FACET_COLUMNS
from telemere.sources.logs import normalise_logs
from telemere.sources.spans import normalise_spans

GRAM = 3
#: Facets that are indexed, by relation.
FACETS = {"logs": ("service", "trace_id"), "spans": ("service", "trace_id", "operation_name")}
TEXT = {"logs": "body", "spans": "name"}
_NORMALISE = {"logs": normalise_logs, "spans": normalise_spans}
_FILE = "_metadata.file_path"


def _term(kind, value):
    return F.xxhash64(F.lit(kind), value)


def _grams(text):
    """The distinct runs of ``GRAM`` characters of a text."""
    last = F.length(text) - (GRAM - 1)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda at: F.substring(text, at, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(cut))


def _terms_of_rows(rows, kind):
    values = [F.array(_term(name, F.col(FACET_COLUMNS[kind][name]))) for name in FACETS[kind]]
    texts = F.transform(_grams(F.col(TEXT[kind])), lambda gram: _term("text", gram))
    every = F.flatten(F.array(*values, F.coalesce(texts, F.array().cast("array<bigint>"))))
    return rows.select("file", F.explode(every).alias("term")).distinct()


def _exists(spark, path):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def index_landed(spark, landing, kind):
    """Index the files of a landing table that its index does not have; one run at a time."""
    path = f"{landing.path}/{kind}_index"
    pages = landing.table(spark, kind).withColumn("file", F.col(_FILE))
    if _exists(spark, f"{path}/files"):
        known = spark.read.parquet(f"{path}/files")
        pages = pages.join(known.select("file"), "file", "left_anti")
    end = F.right(otel.trim_blanks(F.col("body")), F.lit(1))
    sound = F.get_json_object("body", "$").isNotNull() & end.isin("}", "]")
    files = pages.groupBy("file").agg(F.min(F.coalesce(sound, F.lit(False))).alias("whole"))
    rows = _NORMALISE[kind](pages.select("file", "body"), ("file",), on_malformed="skip")
    terms = _terms_of_rows(rows, kind).repartitionByRange("term").sortWithinPartitions("term", "file")
    # The files come last: a run that is cut short adds terms only, which a later run adds once more.
    # Pages that land meanwhile are in neither: both read the files that were there when the run began.
    terms.write.mode("append").parquet(f"{path}/terms")
    files.write.mode("append").parquet(f"{path}/files")


def _short(file):
    """A file's address with one slash where it names no host: Spark writes local ones in two ways."""
    return re.sub(r"^(\w+):///", r"\1:/", file)


def _as_path(file):
    """The path of a file's address, whose characters all stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def wanted_terms(facets, text, kind):
    """Pairs of (kind, value) that all matching files have."""
    found = [(name, value) for name, value in (facets or {}).items() if name in FACETS[kind]]
    return found + [("text", text[at : at + GRAM]) for at in range(len(text or "") - GRAM + 1)]


def candidates(spark, landing, kind, facets=None, text=None):
    """The table's pages in files that may hold matches; None where no index can tell."""
    path = f"{landing.path}/{kind}_index"
    wanted = list(dict.fromkeys(wanted_terms(facets, text, kind)))
    if not wanted or not _exists(spark, f"{path}/files"):
        return None
    keys = spark.createDataFrame(wanted, "kind string, value string").select(F.xxhash64("kind", "value").alias("term")).distinct()
    hashes = [r.term for r in keys.collect()]
    terms = spark.read.parquet(f"{path}/terms").where(F.col("term").isin(hashes))
    hits = terms.groupBy("file").agg(F.count_distinct("term").alias("n")).where(F.col("n") == len(hashes))
    # Names of files, of which Spark's own listing holds all on the driver already.
    without = spark.read.parquet(f"{path}/files").where("whole").join(hits, "file", "left_anti")
    skipped = {_short(r.file) for r in without.select("file").distinct().toLocalIterator()}
    table = landing.table(spark, kind)
    files = table.inputFiles()
    kept = [_as_path(f) for f in files if _short(f) not in skipped]
    if len(kept) == len(files):
        return None
    if not kept:
        return table.where(F.lit(False))
    return spark.read.schema(table.schema).option("basePath", f"{landing.path}/{kind}").parquet(*kept)
