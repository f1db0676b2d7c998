"""The corpus pipeline: documents through five stages, each written as Parquet and read by the next.

A stage is ``function(spark, docs, sf_dir) -> DataFrame`` over all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import functions as F

from telemere.llm import bpe, exact_dedup, ngram_join, queries, raking, string_kernel
from telemere.llm.tables import drop_ids, kept, table


def toxicity(spark, docs, sf_dir):
    """Documents that the string-kernel classifier does not reject; it trains on the labelled ones."""
    model = string_kernel.fit(docs, string_kernel.trainable(table(spark, sf_dir, "labels")))
    return string_kernel.reject(docs, model)


def exact(spark, docs, sf_dir):
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark, docs, sf_dir):
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    groups = ngram_join.near_duplicates(docs)
    return drop_ids(docs, groups.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct())


def mixing(spark, docs, sf_dir):
    """A sample raked to the source, language and topic targets."""
    return raking.sample(docs)


def tokens(spark, docs, sf_dir):
    """Token counts and digests of each document's ids and of their decoded text."""
    return bpe.digests(docs, queries.VOCABULARY)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("mixing", mixing),
    ("bpe", tokens),
]

# A trained classifier and similarity joins are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
