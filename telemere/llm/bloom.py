"""Bloom filters as DataFrames: bitmaps that Spark builds, broadcasts and probes without Python.

A filter is a table of 4 KB bitmaps, ``bucket`` -> ``bits``. Its size is fixed by a
row count and capped at ``MAX_BITS``, so a broadcast of it is bounded by 16 MiB. Past
the cap more rows pass the filter; what is done with them stays exact.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

BITS_A_ROW = 16
MIN_BITS = 1 << 17
MAX_BITS = 1 << 27
HASHES = 2
BUCKET = 32768


def filter_bits(rows):
    """Bits of a filter for ``rows`` rows: a power of two, 16 MiB at most."""
    bits = MIN_BITS
    while bits < min(rows * BITS_A_ROW, MAX_BITS):
        bits *= 2
    return bits


def slots(key, bits):
    """The slots of ``key``: ``HASHES`` independent numbers from 1 to ``bits``."""
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) + 1 for i in range(HASHES)]


def bitmaps(slot_rows):
    """Bitmaps of the slots in column ``slot``."""
    return slot_rows.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")
    )


def repeated(keys, key, bits):
    """The filter of keys that may occur twice: slots that at least two rows hit.

    Every key that does occur twice hits each of its slots twice, so none is missed.
    """
    hit = keys.select(F.explode(F.array(*slots(F.col(key), bits))).alias("slot")).groupBy("slot").count()
    return bitmaps(hit.filter(F.col("count") > 1).select("slot"))


def members(keys, key, bits):
    """The filter of keys that occur at all."""
    return bitmaps(keys.select(F.explode(F.array(*slots(F.col(key), bits))).alias("slot")))


def probe(rows, bitmap, key, bits, flag):
    """``rows`` with ``flag``: whether the filter may hold ``key``. ``rows`` do not move."""
    out = rows
    checks = []
    for i, slot in enumerate(slots(key, bits)):
        at, held = f"{flag}_slot{i}", f"{flag}_bits{i}"
        side = F.broadcast(bitmap.select(F.col("bucket").alias(f"{flag}_bucket{i}"), F.col("bits").alias(held)))
        out = out.withColumn(at, slot)
        out = out.join(side, F.expr(f"bitmap_bucket_number({at})") == F.col(f"{flag}_bucket{i}"), "left")
        place = F.expr(f"bitmap_bit_position({at})")
        byte = F.conv(F.hex(F.expr(f"substring({held}, int(bitmap_bit_position({at}) div 8) + 1, 1)")), 16, 10)
        checks.append(F.coalesce(_bit(byte.cast("int"), place), F.lit(False)))
    out = out.withColumn(flag, reduce(and_, checks))
    return out.drop(*[f"{flag}_{part}{i}" for i in range(HASHES) for part in ("slot", "bucket", "bits")])


def _bit(byte, place):
    return F.pmod(F.floor(byte / F.pow(F.lit(2.0), place % 8)), F.lit(2)) == 1
