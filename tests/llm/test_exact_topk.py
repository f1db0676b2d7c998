import math
import random

import pytest
from pyspark.sql import functions as F

from telemere.llm import exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, block int, state string, share int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k):
    ready = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * x) for x in v]
        ready[i] = min(ready.get(i, q), q)
    out = []
    for i, q in ready.items():
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in ready.items() if j != i)
            out += [(i, place + 1, j, -s) for place, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def rows(n, width=8, seed=1):
    rng = random.Random(seed)
    # Dyadic numbers, so that a float column holds them exactly.
    return [(i, [rng.randint(-64, 64) / 128 for _ in range(width)]) for i in range(n)]


def run(spark, given, k=20):
    return sorted(tuple(r) for r in exact_topk.top_k(table(spark, given), F.col("vec_id") % 20 == 0, k).collect())


def test_equals_brute_force(spark):
    given = rows(300) + [(i, [0.5] * 8) for i in range(300, 420)]  # and a vector that many rows share
    assert run(spark, given) == brute(given, 20)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 16)
    given = rows(200, seed=2) + [(i, [0.25] * 8) for i in range(200, 260)]
    assert run(spark, given) == brute(given, 20)


def test_awkward_vectors(spark):
    given = rows(45, 3) + [(100, None), (120, [None, 1.0, 2.0]), (140, [float("nan"), 1.0, 1.0])]
    given += [(160, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (180, [0.0, 0.0, 0.0]), (7, [1.0, 1.0, 1.0])]
    assert run(spark, given) == brute(given, 20)


def test_fewer_candidates_than_k(spark):
    given = rows(5)
    assert run(spark, given) == brute(given, 20) and len(run(spark, given)) == 4


def test_no_rows_and_no_queries(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0]), (3, [2.0])]) == []


def test_scores_beyond_exactness_fail(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(20, [1e9, 1e9]), (21, [1e9, 1e9])])
