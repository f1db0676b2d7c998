"""Connected components of a table of links, by star contraction."""

from pyspark.sql import functions as F

from telemere.llm.tables import kept

ROUNDS = 60


def _both_ways(links):
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges, least, larger):
    """Link neighbours to the least node around, at the larger neighbours only or at the smaller ones."""
    joined = edges.join(least, "a")
    if larger:
        joined = joined.filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("u"), F.col("least").alias("v"))


def connected(links):
    """``node``, ``component`` for each node of ``links`` (a, b): the component's least node.

    Alternates large stars, in which each node's larger neighbours are linked to the least
    node around it, and small stars, in which its smaller neighbours are. Each round
    halves chains about; links never outnumber those given. Links are a table all the way.
    """
    now = kept(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    for _ in range(ROUNDS):
        both = _both_ways(now)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = kept(_ordered(_star(both, least, True)), "edges")
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a")
        step = small.select(F.col("a").alias("u"), F.col("least").alias("v")).unionByName(
            small.select(F.col("b").alias("u"), F.col("least").alias("v"))
        )
        after = kept(_ordered(step), "edges")
        # Stable when every node hangs on one node and no node that others hang on hangs itself.
        hanging = after.groupBy("a").agg(F.count(F.lit(1)).alias("ways"))
        moving = after.select(F.col("b").alias("a")).distinct().join(hanging.select("a"), "a", "left_semi")
        done = not hanging.filter("ways > 1").take(1) and not moving.take(1)
        now = after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _ordered(edges):
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
