"""Joining a large relation to a lookup without shuffling the large side when that is safe.

:func:`bounded` decides by size when it is called; a bitmap of the lookup's keys is of one size and needs no job.
"""

from pyspark.sql import functions as F

# Rows a lookup may have to be held on the driver and broadcast.
BROADCAST_ROWS = 100_000


def bounded(lookup, max_rows=BROADCAST_ROWS):
    """``lookup`` ready to join: broadcast if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` narrow rows and keeps them, so the
    lookup is not computed twice. A larger lookup comes back as it was and joins
    by shuffle, where adaptive execution splits skewed partitions.
    """
    spark = lookup.sparkSession
    head = lookup.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return lookup
    return F.broadcast(spark.createDataFrame(head, schema=lookup.schema))


# Shares a hot key is spread over when a join has to shuffle its rows.
SALTS = 16


def salted_join(rows, lookup, keys, spread):
    """Inner join of many rows to one lookup row per key, each key spread over ``SALTS`` tasks.

    An aggregate on more than the keys would otherwise reuse the join's partitioning,
    which keeps adaptive execution from splitting a hot key.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def join_lookup(rows, lookup, keys, spread, max_rows=BROADCAST_ROWS):
    """Inner join to one lookup row per key: broadcast when small enough, else salted."""
    checked = bounded(lookup, max_rows)
    if checked is lookup:
        return salted_join(rows, lookup, keys, spread)
    return rows.join(checked, list(keys))


# Bits of a key bitmap: one aggregate buffer of Spark's bitmap functions.
BITMAP_BITS = 32_768


def key_bitmap(lookup, *keys):
    """A scalar of ``BITMAP_BITS`` bits, those of the hashes of the keys set, whatever the number of keys."""
    return lookup.agg(F.bitmap_construct_agg(_position(keys)).alias("_bits")).scalar()


def maybe_among(bitmap, *keys):
    """Whether a row's keys may be among those of the bitmap: never false for one that is."""
    at = _position(keys)
    byte = F.conv(F.hex(F.substring(bitmap, (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1


def _position(keys):
    return F.pmod(F.xxhash64(*keys), F.lit(BITMAP_BITS))


# A key is hot with more than one row in ``HOT_SHARE``; a hot key gets a share for each 1 / ``SHARES`` of all rows.
HOT_SHARE, SHARES = 1000, 200
# Items that the sketch of frequent keys tracks; its counts are off by at most about total / TRACKED.
TRACKED = 16_384


def hot_keys(rows, key):
    """A scalar: the hot values of ``key`` with the shares their counts ask for, fewer than ``HOT_SHARE`` of them.

    They come from a sketch of frequent items of fixed size, in one pass without a shuffle by key.
    """
    top = F.call_function("approx_top_k", key, F.lit(HOT_SHARE), F.lit(TRACKED))
    sketch = rows.agg(top.alias("_top"), F.count(key).alias("_total"))
    hot = F.filter("_top", lambda t: t["count"] * HOT_SHARE > F.col("_total"))
    sized = F.transform(
        hot, lambda t: F.struct(t["item"].alias("key"), F.ceil(t["count"] * SHARES / F.col("_total")).cast("int").alias("shares"))
    )
    return sketch.select(sized.alias("_hot"))


def spread_join(rows, lookup, keys, spread, how):
    """Join many rows to at most one lookup row per key, the rows of hot keys over as many tasks as their number asks.

    ``spread`` are columns of ``rows`` whose hash picks a row's share. Every row meets one copy of its
    lookup row, so any ``how`` that keeps or drops rows of ``rows`` does. The hint keeps the lookup off the
    driver: the size guessed for keys taken out of JSON pages is far too small, and they would be broadcast.
    """
    name = F.concat_ws("\x00", *[F.col(k).cast("string") for k in keys])
    hot = hot_keys(rows.select(name.alias("_key")), "_key")
    # Shares and bitmap come in one scalar, so that the keys are sketched once.
    held = hot.select(F.explode("_hot").alias("_hot")).agg(
        F.map_from_entries(F.collect_list("_hot")).alias("_listed"),
        F.bitmap_construct_agg(_position(["_hot.key"])).alias("_bits"),
    )
    found = held.select(F.struct("_listed", "_bits")).scalar()
    listed, bits = found["_listed"], found["_bits"]

    def shares(df):
        found = F.try_element_at(listed, F.col("_key"))
        named = df.withColumn("_key", name)
        return named.withColumn("_shares", F.when(maybe_among(bits, "_key"), F.coalesce(found, F.lit(1))).otherwise(F.lit(1)))

    dealt = shares(rows).withColumn("_share", F.pmod(F.xxhash64(*spread), F.col("_shares")).cast("int"))
    copies = shares(lookup).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    copies = copies.drop("_key", "_shares").hint("merge")
    return dealt.drop("_key", "_shares").join(copies, [*keys, "_share"], how).drop("_share")
