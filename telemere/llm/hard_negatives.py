"""Hard negatives by vertical scans of blocks of vectors (BOND).

Vectors lie in blocks, one column a dimension, with each column's least and greatest
value. An anchor reads a block's columns in the order of its own components' sizes. What
the unread columns can still add lies between two sums of their extremes, the same for
all rows of the block, so each row's score has a lower and an upper bound. Rows whose
bounds leave every score that is asked for drop out of the anchor's bitmap; those left when
all columns are read have exact scores.

Two scans answer a wave of anchors: the first finds the k best rows of the anchor's label, where
the kth lower bound seen is the least score asked for; the second knows the positives' scores
and so the windows of the negatives, and the kth lower bound among rows that lie in a window for
certain is again the least score asked for there.

A wave is as many anchors as fit ``WAVE_BYTES``; that is what is sent to all tasks, whatever
the number of anchors. Candidates never move: a task scans its blocks and keeps, for each
anchor of the wave and window, k rows. Waves follow one another, each written when done.

Defined cases: a row with a null id, label or vector, or with a null or non-finite component,
takes no part; a shorter vector counts as filled up with zeros; components and scores beyond 64
bits count as the nearest that fits. Rows that repeat an id are rows of their own, but never
candidates for an anchor with their id. A window that holds no row gives none, as do an empty table and
one without anchors. Columns other than ``vec_id``, ``embedding`` and ``label`` may have any name.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemere.llm.tables import kept, map_arrow
from telemere.session import shared_dir

SCALE = 256
BLOCK = 8192
WAVE_BYTES = 8 << 20
# Columns read between two looks at the bounds.
STEP = 8
POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90

_BLOCKS = "ids binary, labels binary, columns binary, width int"
_FOUND = "number long, place int, vec_id long, score long"
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def quantised(vectors, label):
    """vec_id, label and whole-number components of the rows that take part; ``label`` is a column of longs."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"),
    )


def _matrix(column):
    """A list column -> rows by dimensions, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(limit):
    """Vectors -> blocks of at most ``limit`` of them, their components column by column."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, limit):
                part = batch.slice(start, limit)
                matrix = _matrix(part.column(2))
                yield pa.record_batch(
                    [
                        pa.array([part.column(0).to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                        pa.array([part.column(1).to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                        pa.array([np.ascontiguousarray(matrix.T).tobytes()], pa.binary()),
                        pa.array([matrix.shape[1]], pa.int32()),
                    ],
                    names=["ids", "labels", "columns", "width"],
                )

    return run


class Block:
    """A block of candidates: ids, labels, columns, and the extremes of each column."""

    def __init__(self, ids, labels, columns, width, reach):
        self.ids = np.frombuffer(ids, np.int64)
        self.labels = np.frombuffer(labels, np.int64)
        whole = np.frombuffer(columns, np.int64).reshape(width, len(self.ids))
        most = max(abs(int(whole.max(initial=0))), abs(int(whole.min(initial=0))))
        # Sums of products are exact as doubles below 2 ** 53, else as Python's integers.
        self.kind = np.float64 if most * reach * max(width, 1) < 1 << 53 else object
        self.columns = whole.astype(self.kind)
        self.low = whole.min(axis=1, initial=_HIGH).astype(self.kind)
        self.high = whole.max(axis=1, initial=_LOW).astype(self.kind)


def _fit(scores):
    if scores.dtype == object:
        return np.array([min(max(s, _LOW), _HIGH) for s in scores.tolist()], np.int64)
    return scores.astype(np.int64)


def vertical_scan(anchor, columns, low, high, bitmap):
    """Positions in ``columns`` that ``bitmap(partial, least, most)`` never dropped, and their exact scores.

    ``least`` and ``most`` bound what the unread columns add to each of the ``partial`` scores.
    """
    width = min(len(anchor), len(columns))
    order = np.argsort(-np.abs(anchor[:width]), kind="stable")
    weights = anchor[order].astype(columns.dtype)
    ends = weights * low[order], weights * high[order]
    least, most = np.minimum(*ends), np.maximum(*ends)
    # What is left to add behind each number of columns read.
    least, most = (np.concatenate([np.cumsum(x[::-1])[::-1], np.zeros(1, x.dtype)]) for x in (least, most))
    alive, partial = np.arange(columns.shape[1]), np.zeros(columns.shape[1], columns.dtype)
    for at in range(0, width, STEP):
        read = columns[order[at : at + STEP]]
        if len(alive) < columns.shape[1]:
            read = read[:, alive]
        partial = partial + weights[at : at + STEP] @ read
        end = min(at + STEP, width)
        keep = bitmap(partial, least[end], most[end])
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
    return alive, partial


def _first(ids, scores, k):
    """The places of the k highest scores, ties to smaller ids."""
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
        return at[_order(ids[at], scores[at])[:k]]
    return _order(ids, scores)[:k]


def _order(ids, scores):
    # Complements, not negatives: the least integer has no negative.
    return np.lexsort((ids, ~scores))


class Best:
    """For each anchor of a wave and each of its windows, the k best rows that a task has seen."""

    def __init__(self, anchors, windows, k):
        self.k = k
        self.n = np.zeros((anchors, windows), np.int32)
        self.ids = np.zeros((anchors, windows, k), np.int64)
        self.scores = np.zeros((anchors, windows, k), np.int64)

    def edge(self, anchor, window):
        """The score below which no row can enter, or None."""
        return self.scores[anchor, window, self.k - 1] if self.n[anchor, window] == self.k else None

    def add(self, anchor, window, ids, scores):
        n = self.n[anchor, window]
        ids = np.concatenate([self.ids[anchor, window, :n], ids])
        scores = np.concatenate([self.scores[anchor, window, :n], scores])
        at = _first(ids, scores, self.k)
        self.n[anchor, window] = len(at)
        self.ids[anchor, window, : len(at)] = ids[at]
        self.scores[anchor, window, : len(at)] = scores[at]

    def rows(self, numbers):
        held = np.arange(self.k) < self.n[:, :, None]
        anchor, window, _ = np.nonzero(held)
        return pa.record_batch(
            [pa.array(numbers[anchor]), pa.array(window.astype(np.int32)), pa.array(self.ids[held]), pa.array(self.scores[held])],
            names=["number", "place", "vec_id", "score"],
        )


def _above(edge, k):
    """Keeps what may be among the k best."""

    def keep(partial, least, most):
        floor = edge
        if len(partial) >= k:
            sure = np.partition(partial, len(partial) - k)[len(partial) - k] + least
            floor = sure if floor is None else max(floor, sure)
        return np.ones(len(partial), bool) if floor is None else partial + most >= floor

    return keep


def _inside(windows, edges, k):
    """Keeps what may be in one of the windows (low, high) and not below its kth sure row."""

    def keep(partial, least, most):
        lower, upper = partial + least, partial + most
        kept_ = np.zeros(len(partial), bool)
        for (low, high), edge in zip(windows, edges, strict=True):
            floor = low if edge is None else max(low, edge)
            sure = lower[(lower >= low) & (upper <= high)]
            if len(sure) >= k:
                floor = max(floor, np.partition(sure, len(sure) - k)[len(sure) - k])
            kept_ |= (upper >= floor) & (lower <= high)
        return kept_

    return keep


def _scan(wave, k, negatives):
    """Blocks -> for each anchor of the wave the task's best rows: of its label, or inside its windows."""

    def run(batches):
        given = wave.value
        ids, labels, vectors, windows = given["ids"], given["labels"], given["vectors"], given["windows"]
        best = Best(len(ids), windows.shape[1] if negatives else 1, k)
        groups = [(label, np.flatnonzero(labels == label)) for label in np.unique(labels)]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(**row, reach=given["reach"])
                for label, anchors in groups:
                    at = np.flatnonzero((block.labels != label) if negatives else (block.labels == label))
                    if not len(at):
                        continue
                    columns, candidates = block.columns[:, at], block.ids[at]
                    for i in anchors:
                        self_ = candidates == ids[i]
                        if negatives:
                            wide = [tuple(w) for w in windows[i].tolist()]
                            edges = [best.edge(i, j) for j in range(len(wide))]
                            bitmap = _inside(wide, edges, k)
                        else:
                            bitmap = _above(best.edge(i, 0), k + int(self_.sum()))
                        alive, scores = vertical_scan(vectors[i], columns, block.low, block.high, bitmap)
                        alive_ids, scores = candidates[alive], _fit(scores)
                        other = ~self_[alive]
                        for j, (low, high) in enumerate(wide if negatives else [(_LOW, _HIGH)]):
                            hit = other & (scores >= low) & (scores <= high)
                            if hit.any():
                                best.add(i, j, alive_ids[hit], scores[hit])
        yield best.rows(given["numbers"])

    return run


def _merged(found, k):
    """The best k of what all tasks kept, with their rank from 1."""
    order = W.partitionBy("number", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _wave(anchors, windows=None):
    """A wave's anchors as arrays; ``windows`` has rows (number, place, low, high) of this wave."""
    got = anchors.select("number", "vec_id", "label", "v").orderBy("number").toArrow()
    numbers = got.column(0).to_numpy()
    vectors = _matrix(got.column(3))
    bounds = np.empty((len(numbers), POSITIVES if windows is not None else 0, 2), np.int64)
    bounds[:, :, 0], bounds[:, :, 1] = _HIGH, _LOW  # no score is in such a window
    if windows is not None:
        at = np.searchsorted(numbers, windows.column(0).to_numpy())
        bounds[at, windows.column(1).to_numpy()] = np.stack([windows.column(2).to_numpy(), windows.column(3).to_numpy()], 1)
    reach = max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0))))
    return {
        "numbers": numbers, "ids": got.column(1).to_numpy(), "labels": got.column(2).to_numpy(),
        "vectors": vectors, "windows": bounds, "reach": reach,
    }


def _window_bounds(place_rank, score):
    """Whole scores s with LEAST * score <= 100 * s <= MOST * score."""
    wide = score.cast("decimal(24,0)")
    low, high = F.ceil(wide * LEAST / 100), F.floor(wide * MOST / 100)
    return [(place_rank - 1).alias("place"), low.cast("long").alias("low"), high.cast("long").alias("high")]


def mine(vectors, is_anchor, label=None):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each anchor and positive.

    ``is_anchor`` is a condition on ``vec_id``; ``label`` replaces the column ``label``.
    """
    spark = vectors.sparkSession
    label = F.col("label").cast("long") if label is None else label
    ready = kept(quantised(vectors, label), "vectors")
    blocks = kept(map_arrow(ready, _packed(BLOCK), _BLOCKS), "blocks")
    anchors = kept(ready.filter(is_anchor).withColumn("number", F.monotonically_increasing_id()), "anchors")
    n, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    # Half filled on average, so that no wave is far above the bound.
    waves = -(-2 * n * 8 * max(width or 1, 1) // WAVE_BYTES)
    folder = shared_dir(spark, "negatives")
    schema = f"{_FOUND}, rank int, anchor_id long, positive_id long, positive_score long"
    for w in range(max(waves, 1) if n else 0):
        own = anchors.filter(F.pmod(F.xxhash64("number"), F.lit(waves)) == w)
        sent = spark.sparkContext.broadcast(_wave(own))
        positives = kept(
            _merged(map_arrow(blocks, _scan(sent, POSITIVES, False), _FOUND), POSITIVES).select(
                "number",
                F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
                *_window_bounds(F.col("rank"), F.col("score")),
            ),
            "positives",
        )
        sent.unpersist()
        sent = spark.sparkContext.broadcast(_wave(own, positives.select("number", "place", "low", "high").toArrow()))
        found = _merged(map_arrow(blocks, _scan(sent, NEGATIVES, True), _FOUND), NEGATIVES)
        names = own.select("number", F.col("vec_id").alias("anchor_id"))
        held = positives.join(names, "number").select("number", "place", "anchor_id", "positive_id", "positive_score")
        found.join(held, ["number", "place"]).select(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(folder)
        sent.unpersist()
    rows = spark.read.schema(schema).parquet(folder) if n else spark.createDataFrame([], schema)
    return rows.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
