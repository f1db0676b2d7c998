"""Reading tables, keeping intermediate tables and joining without hot keys."""

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from telemere.llm import bloom
from telemere.session import shared_dir


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df, purpose, **options):
    """``df`` written below the shared folder and read again: lineage ends there.

    The files outlive lost executors. They are narrow in every use here.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name):
    """A column name that no caller's table has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


# A group is hot when it holds more than one row in so many; so at most this many groups are hot.
HOT_SHARE = 1000


def join_groups(rows, groups, key, size, total, share=HOT_SHARE):
    """Left join of ``rows`` to one row of ``groups`` for each value of ``key``, whatever the skew.

    ``groups[size]`` counts the rows of a group among ``total`` rows, so fewer than
    ``share`` groups can be larger than ``total / share``. Those few are broadcast;
    rows of all others shuffle, and none of their groups weighs on a task.
    """
    limit = max(1, total // share)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    added = [c for c in groups.columns if c != key]
    flagged = rows.join(F.broadcast(hot), key, "left")
    found = flagged.filter(F.col(size).isNotNull())
    rest = flagged.filter(F.col(size).isNull()).drop(*added).join(cold, key, "left")
    return found.unionByName(rest)


def drop_ids(docs, ids):
    """``docs`` without the rows whose doc_id is among the distinct ``ids``; null ids stay.

    A Bloom filter of the ids, bounded in size, is probed first: rows that it clears stay
    where they are, and only the others shuffle for the exact anti join.
    """
    ids = kept(ids.select(F.col("doc_id").cast("long").alias("doc_id")), "dropped")
    bits = bloom.filter_bits(ids.count())
    maybe = fresh("maybe")
    probed = bloom.probe(docs, bloom.members(ids, "doc_id", bits), F.col("doc_id").cast("long"), bits, maybe)
    sure = probed.filter(~F.col(maybe)).drop(maybe)
    rest = probed.filter(F.col(maybe)).drop(maybe)
    key = fresh("id")
    checked = rest.join(ids.withColumnRenamed("doc_id", key), F.col("doc_id").cast("long") == F.col(key), "left_anti")
    return sure.unionByName(checked)


# Bytes of one Arrow batch: what a Python task holds at once does not depend on how long texts are.
BATCH_BYTES = "4m"


def released(batches):
    """``batches``, after which a Python worker gives back to the machine what its task took and freed.

    Workers outlive stages, so what one stage leaves would count against the next.
    """
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_arrow(df, function, schema):
    """``mapInArrow`` with batches bounded in bytes, whose workers release their memory at a task's end."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(lambda batches: released(function(batches)), schema)
