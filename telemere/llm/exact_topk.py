"""Exact top-k by distributed histogram selection.

Vectors are integers, so scores are. All rows are scored against the queries in blocks,
again in each round, and no scores are kept: a round counts, for each query, the scores
that fall into each of ``BINS`` bins of the interval that holds its kth value. The sums
of those counts narrow the interval to one bin, and rounds go on until it is one number.
A last pass keeps every score above that number and, of the scores equal to it, as many
as are missing with the smallest ids.

A task holds one block of queries and one of candidates at a time. Query blocks are
spread over several tasks by a share of the candidate blocks, so a few queries keep
all tasks busy. What moves are blocks of vectors and, per query and task, ``BINS`` counts.

Defined cases: a vector that is null or holds a null or non-finite component takes no part,
nor does a row with a null id; rows that repeat an id are one, with the smallest of their
vectors; a shorter vector counts as filled up with zeros. A query with fewer than k
candidates gets them all. Scores must be below 2 ** 53 in size, else the job fails. Columns
other than ``vec_id`` and ``embedding`` may have any name. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemere.llm.tables import kept, map_arrow

BINS = 128
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 4096
SCALE = 64

_BLOCK = "ids binary, vectors binary, width int, longest double"


def quantised(vectors):
    """vec_id and the vector's components as floor(SCALE * x), of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(whole)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"),
        )
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _packed(limit):
    """Rows of vectors -> blocks of at most ``limit`` of them, ordered by id."""

    def block(rows):
        rows.sort(key=lambda r: r[0])
        width = max(len(v) for _, v in rows)
        matrix = np.zeros((len(rows), width), np.int64)
        for i, (_, v) in enumerate(rows):
            matrix[i, : len(v)] = v
        longest = float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)).max()) if width else 0.0
        ids = np.array([r[0] for r in rows], np.int64)
        return ids.tobytes(), matrix.tobytes(), width, longest

    def run(batches):
        rows = []
        for batch in batches:
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append(pair)
                if len(rows) == limit:
                    yield _record([block(rows)])
                    rows = []
        if rows:
            yield _record([block(rows)])

    return run


def _record(blocks):
    ids, vectors, width, longest = zip(*blocks, strict=True)
    return pa.record_batch(
        [
            pa.array(ids, pa.binary()),
            pa.array(vectors, pa.binary()),
            pa.array(width, pa.int32()),
            pa.array(longest, pa.float64()),
        ],
        names=["ids", "vectors", "width", "longest"],
    )


def _blocks(vectors, limit, purpose):
    """Numbered blocks. The numbers come from a list of block keys: one for each ``limit`` vectors."""
    blocks = kept(
        map_arrow(vectors, _packed(limit), _BLOCK).withColumn("key", F.monotonically_increasing_id()), purpose
    )
    keys = sorted(r[0] for r in blocks.select("key").collect())
    numbers = blocks.sparkSession.createDataFrame(list(enumerate(keys)), "block int, key long")
    return blocks.join(F.broadcast(numbers), "key").drop("key"), len(keys)


def _matrix(vectors, width, n, columns, kind):
    out = np.zeros((n, columns), kind)
    if width:
        out[:, :width] = np.frombuffer(vectors, np.int64).reshape(n, width)
    return out


def scored(row, exact=2**53):
    """Query ids, candidate ids and their matrix of scores; the query's own row has the score -inf."""
    q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
    bound = row["q_longest"] * row["c_longest"]
    if bound >= exact:
        raise ValueError("scores are too large to be exact")
    kind = np.float32 if bound < 2**23 else np.float64
    columns = max(row["q_width"], row["c_width"])
    scores = (
        _matrix(row["q_vectors"], row["q_width"], len(q_ids), columns, kind)
        @ _matrix(row["c_vectors"], row["c_width"], len(c_ids), columns, kind).T
    )
    at = np.searchsorted(c_ids, q_ids)
    own = np.flatnonzero((at < len(c_ids)) & (c_ids[np.minimum(at, len(c_ids) - 1)] == q_ids))
    scores[own, at[own]] = -np.inf
    return q_ids, c_ids, scores


def _rows(batch):
    for i in range(batch.num_rows):
        yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _count(batches):
    """Pairs of blocks with a state -> for each query block of the task its counts by query and bin."""
    sums = {}
    for batch in batches:
        for row in _rows(batch):
            q_ids, _, scores = scored(row)
            state = np.frombuffer(row["state"], np.int64).reshape(3, -1)
            low, high = state[0][:, None], state[1][:, None]
            step = (high - low) // BINS + 1
            inside = (scores >= low) & (scores <= high)
            query, at = np.nonzero(inside)
            bins = (scores[query, at].astype(np.int64) - state[0][query]) // step[query, 0]
            counts = np.bincount(query * BINS + bins, minlength=len(q_ids) * BINS)
            key = row["block"]
            sums[key] = (sums[key][0] + counts, row["state"]) if key in sums else (counts, row["state"])
    yield _state_batch([(key, counts.tobytes(), state) for key, (counts, state) in sums.items()])


def _state_batch(rows):
    return pa.record_batch(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))],
        names=["block", "counts", "state"],
    )


def _narrow(k):
    """Counts of the tasks -> the next state of each query block: low, high, scores above high."""

    def run(batches):
        sums = {}
        for batch in batches:
            for row in _rows(batch):
                counts = np.frombuffer(row["counts"], np.int64)
                key = row["block"]
                sums[key] = (sums[key][0] + counts if key in sums else counts, row["state"])
        blocks, states = [], []
        for key, (counts, state) in sums.items():
            low, high, above = np.frombuffer(state, np.int64).reshape(3, -1)
            counts = counts.reshape(-1, BINS)
            step = (high - low) // BINS + 1
            reach = above[:, None] + np.cumsum(counts[:, ::-1], axis=1)  # scores at or above each bin, from the top
            enough = reach >= k
            top = np.where(enough.any(axis=1), enough.argmax(axis=1), BINS - 1)
            before = np.where(top > 0, np.take_along_axis(reach, np.maximum(top - 1, 0)[:, None], 1)[:, 0], above)
            bin_ = BINS - 1 - top
            first = low + bin_ * step
            blocks.append(key)
            states.append(np.stack([first, np.minimum(first + step - 1, np.maximum(high, first)), before]).tobytes())
        yield pa.record_batch([pa.array(blocks, pa.int32()), pa.array(states, pa.binary())], names=["block", "state"])

    return run


def _select(k):
    """Pairs of blocks with their final states -> the scores that may be among the k highest."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                q_ids, c_ids, scores = scored(row)
                least, _, above = np.frombuffer(row["state"], np.int64).reshape(3, -1)
                ties = scores == least[:, None]
                ties &= np.cumsum(ties, axis=1) <= (k - above)[:, None]  # candidates are in order of id
                query, at = np.nonzero((scores > least[:, None]) | ties)
                yield pa.record_batch(
                    [
                        pa.array(q_ids[query]),
                        pa.array(c_ids[at]),
                        pa.array(scores[query, at].astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def _first_state(longest):
    """Every interval wide enough for all scores, by the lengths of the vectors."""

    def run(batches):
        for batch in batches:
            states = []
            for row in _rows(batch):
                n = len(row["ids"]) // 8
                bound = int(row["longest"] * longest) + 1
                states.append(np.stack([np.full(n, -bound), np.full(n, bound), np.zeros(n, np.int64)]).tobytes())
            yield pa.record_batch([batch.column(0), pa.array(states, pa.binary())], names=["block", "state"])

    return run


def top_k(vectors, is_query, k=20):
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query row with all other rows.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    ready = kept(quantised(vectors), "vectors")
    candidates, n_candidates = _blocks(ready, CANDIDATE_BLOCK, "candidates")
    queries, n_queries = _blocks(ready.filter(is_query), QUERY_BLOCK, "queries")
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    longest = candidates.agg(F.max("longest")).first()[0]
    widest = int(queries.agg(F.max("longest")).first()[0] * longest) + 1

    shares = max(1, min(n_candidates, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // n_queries)))
    every = candidates.select(
        *[F.col(c).alias(f"c_{c}") for c in ("ids", "vectors", "width", "longest")],
        (F.col("block") % shares).alias("share"),
        F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("block"),
    )

    def pairs(state):
        held = queries.join(state, "block").select(
            "block", "state", *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "width", "longest")]
        )
        held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        return every.join(held, ["block", "share"])

    state = kept(
        map_arrow(queries.select("block", "ids", "longest"), _first_state(longest), "block int, state binary"), "state"
    )
    span = 2 * widest + 1
    while span > 1:
        counts = map_arrow(pairs(state), _count, "block int, counts binary, state binary")
        state = kept(map_arrow(counts.repartition("block"), _narrow(k), "block int, state binary"), "state")
        span = (span - 1) // BINS + 1
    found = map_arrow(pairs(state), _select(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
