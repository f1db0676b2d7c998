"""Exact duplicates by two-pass Bloom filtering, in DataFrame operations only.

Pass one hashes every text and counts, for each slot of a Bloom filter, the rows
that hit it; slots hit twice make the filter of possibly repeated hashes. Pass two
probes each row where it stands. Rows the filter clears are alone in their text and
pass straight through; only the others shuffle and are grouped by SHA-256.

Defined cases: a null text counts as empty, and all empty texts are equal. Of equal
texts the row with the largest ``doc_id`` stays; a null id is smaller than any other.
Rows that repeat one id and one text are told apart by an arbitrary but fixed order,
so exactly one row of a group stays. Columns other than ``doc_id`` and ``text`` may
have any name. An empty table gives an empty result.
"""

from pyspark.sql import functions as F

from telemere.llm import bloom
from telemere.llm.tables import fresh, join_groups, kept


def text_hash(text):
    """SHA-256 of the text's UTF-8 bytes in lowercase hex; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _hashes(docs):
    return kept(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(text_hash(F.col("text"))).alias("digest"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "hashes",
    )


def _filter(hashes):
    total = hashes.count()
    bits = bloom.filter_bits(total)
    return total, bits, bloom.repeated(hashes, "digest", bits)


def flag_duplicates(docs):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    hashes = _hashes(docs)
    total, bits, bitmap = _filter(hashes)
    probed = bloom.probe(hashes, bitmap, F.col("digest"), bits, "suspect")
    alone = probed.filter(~F.col("suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    suspects = probed.filter(F.col("suspect")).drop("suspect")
    groups = suspects.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row_id")).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    decided = join_groups(suspects, groups, "digest", "group_size", total).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row_id") == F.col("row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return alone.unionByName(decided)


def drop_duplicates(docs):
    """The rows that stay, all their columns unchanged."""
    hashes = _hashes(docs)
    _, bits, bitmap = _filter(hashes)
    digest, suspect, whole = fresh("digest"), fresh("suspect"), fresh("row")
    probed = bloom.probe(
        docs.withColumn(digest, F.unhex(text_hash(F.col("text")))), bitmap, F.col(digest), bits, suspect
    )
    alone = probed.filter(~F.col(suspect)).select(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.max_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct(F.col("doc_id").isNotNull(), "doc_id"))
    stay = probed.filter(F.col(suspect)).groupBy(digest).agg(first.alias(whole)).select(f"{whole}.*")
    return alone.unionByName(stay)
