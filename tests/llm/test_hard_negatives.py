import math
import random

from pyspark.sql import functions as F

from telemere.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, number string, place int, v int, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)


def plain(rows, every=100):
    ready = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ready.append((i, [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, a, label in ready:
        if i % every:
            continue
        scored = []
        for j, v, other in ready:
            if j != i:
                score = sum(x * y for x, y in zip(a, v, strict=False))
                scored.append((-max(-(2**63), min(2**63 - 1, score)), j, other == label))
        scored.sort()
        for p, pid, _ in [s for s in scored if s[2]][:5]:
            fit = [(n, j) for n, j, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(i, pid, place + 1, j, -p, -n) for place, (n, j) in enumerate(fit[:10])]
    return sorted(out)


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))


def run(spark, rows, every=100):
    got = hard_negatives.mine(table(spark, rows), F.col("vec_id") % every == 0, label())
    return sorted(tuple(r) for r in got.collect())


def rows(n, width=24, seed=1, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.1, 0.3) * (2 if d % 5 == 0 else 1) for d in range(width)], rng.randrange(labels)) for i in range(n)]


def test_equals_plain_version(spark):
    given = rows(900)
    same = rows(1, seed=9)[0][1]
    given += [(i, same, i % 3) for i in range(900, 1150)]  # a vector that many rows share, in several labels
    want = plain(given, 50)
    assert run(spark, given, 50) == want and len(want) > 500


def test_small_blocks_and_several_waves(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "WAVE_BYTES", 1 << 10)
    given = rows(400, seed=2, labels=2)
    assert run(spark, given, 20) == plain(given, 20)


def test_awkward_rows(spark):
    given = rows(120, 9, seed=3, labels=2)
    given += [(200, None, 1), (300, [None, 1.0], 1), (400, [math.nan, 1.0], 1), (500, [math.inf], 1), (600, [1.0, 2.0], None)]
    given += [(None, [1.0, 1.0], 1), (700, [], 1), (800, [0.5, 0.25], 0), (100, [0.3] * 12, 1), (100, [0.3] * 12, 1), (7, [0.2] * 9, 3)]
    assert run(spark, given) == plain(given)


def test_large_components(spark):
    given = rows(60, 6, seed=4, labels=2)
    given += [(100 + i, [x * 10.0 ** (i % 19) for x in v], c) for i, v, c in rows(120, 6, seed=5, labels=2)]
    assert run(spark, given, 20) == plain(given, 20)


def test_no_rows_anchors_or_positives(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 0), (3, [2.0], 1)]) == []
    assert run(spark, [(0, [1.0], 0), (1, [0.5], 5)]) == []


def test_query_is_registered():
    assert "op13_hard_negatives" in queries.QUERIES and "op13_hard_negatives" in queries.ORACLES
