"""Which of several overlapping reads answers for an instant: the newest that covers it.

Reads of a source overlap, so the same event or point lands more than once. No row has to be
compared with another to keep one: the reads themselves say which time each of them covers
and when it was taken, and a sweep over these few numbers gives every read the parts of time
that no newer one covers. Rows outside their read's parts belong to a newer read.
"""

import heapq

import pyarrow as pa
from pyspark.sql import functions as F

# Time is swept in pieces of one day, so reads of one source are dealt to as many tasks as days.
CELL_MS = 86_400_000

_PIECES = "array<struct<from:long,to:long>>"


def _sweep(reads):
    """The reads of one source and cell -> read, from, to: disjoint, the newest read on top."""
    spans = sorted(
        zip(*(reads.column(n).to_pylist() for n in ("from", "to", "taken", "read")), strict=True),
        key=lambda r: (r[0], r[1]),
    )
    edges = sorted({edge for start, end, _, _ in spans for edge in (start, end)})
    open_, owned, at = [], [], 0
    for edge, following in zip(edges, edges[1:], strict=False):
        while at < len(spans) and spans[at][0] <= edge:
            start, end, taken, read = spans[at]
            heapq.heappush(open_, (-taken, _Last(read), end))
            at += 1
        while open_ and open_[0][2] <= edge:
            heapq.heappop(open_)
        if open_:
            read = open_[0][1].value
            if owned and owned[-1][0] == read and owned[-1][2] == edge:
                owned[-1][2] = following
            else:
                owned.append([read, edge, following])
    names = ("read", "from", "to")
    columns = list(zip(*owned, strict=True)) or [[], [], []]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, (pa.string(), pa.int64(), pa.int64()), strict=True)})


class _Last:
    """Orders texts backwards: of reads taken at one moment the one with the greatest name counts."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return self.value > other.value


def owned_times(reads, source=()):
    """read, pieces: the half-open parts of time (``from``, ``to``) for which a read is the newest.

    ``reads`` has ``read`` (its name, a string), ``from``, ``to`` in milliseconds, ``taken`` and the ``source``
    columns that tell apart reads of different things. Repeated rows of a read count once; an
    empty read, or one that newer reads cover whole, has no row.
    """
    cell = F.explode(
        F.sequence(F.floor(F.col("from") / CELL_MS), F.floor((F.col("to") - 1) / CELL_MS))
    ).alias("_cell")
    start = F.greatest("from", F.col("_cell") * CELL_MS).alias("from")
    end = F.least("to", (F.col("_cell") + 1) * CELL_MS).alias("to")
    cut = reads.where(F.col("from") < F.col("to")).select(*source, "read", "from", "to", "taken").distinct()
    cut = cut.select("*", cell).select(*source, "_cell", "read", start, end, "taken")
    pieces = cut.groupBy(*source, "_cell").applyInArrow(_sweep, "read string, from long, to long")
    return pieces.groupBy("read").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).cast(_PIECES).alias("pieces"))


def is_owned(pieces, instant_ms):
    """Whether an instant lies in one of a read's pieces; false for none and for a missing instant."""
    return F.coalesce(F.exists(pieces, lambda p: (p["from"] <= instant_ms) & (instant_ms < p["to"])), F.lit(False))
