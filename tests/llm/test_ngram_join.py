import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from telemere.llm import components, ngram_join, shingles
from tests.llm.data import documents, empty, plain, words
from tests.llm.data import shingles as plain_shingles


def brute(rows):
    """Components by comparing all pairs of sets."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, plain_shingles(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            same = len(a & b)
            if a and 100 * same >= 80 * (len(a) + len(b) - same):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((str(i), len(plain_shingles(t)), None if i is None else find(i)) for i, t in rows)


def run(docs):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())


def chain(n):
    """Texts that each link with the next one only, and a crowd around one text."""
    rng = random.Random(8)
    now = words(rng, 60).split()
    rows = []
    for i in range(n):
        rows.append((1000 + 2 * i, " ".join(now), "en", "s"))
        now = [*now[3:], *words(rng, 3).split()]
    crowd = [f"w{i}" for i in range(200)]
    for i in range(40):
        own = list(crowd)
        own[rng.randrange(200)] = f"z{i}"
        own[rng.randrange(200)] = f"y{i}"
        rows.append((3000 + i, " ".join(own), "en", "s"))
    return rows


def frequent(share):
    def made(scan, tokens, counters):
        return np.random.default_rng(1).random(counters) < share

    return made


@pytest.mark.parametrize("share", [None, 0.5, 1.0])
def test_equals_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(ngram_join, "SHARE_TOKENS", 2000)
    if share is not None:  # token pairs instead of single tokens for this share of the counters
        monkeypatch.setattr(ngram_join, "frequent_counters", frequent(share))
    docs = documents(spark, chain(12))
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("shares", [1, 2])
def test_a_block_gives_fewer_links_than_members(shares):
    """A dense crowd links all with all; one link for each component joined says as much."""
    rng = random.Random(5)
    crowd = words(rng, 200).split()
    texts = [" ".join([*crowd, f"own{i}"]) for i in range(60)] + [words(rng, 40), words(rng, 40)]
    pdf = pd.DataFrame({"node": np.arange(62), "component": np.arange(62), "share": np.arange(62) % shares, "text": texts})
    pdf["component"] = pdf["component"].where(pdf["node"] > 2, 0)
    found = ngram_join._block_links(pdf.assign(low=0, high=shares - 1))
    assert len(found) == 57  # 58 components of the crowd become one
    joined = {0, 1, 2}
    rows = list(zip(found["a"], found["b"], strict=True))
    while any((a in joined) != (b in joined) for a, b in rows):
        joined |= {x for a, b in rows if a in joined or b in joined for x in (a, b)}
    assert joined == set(range(60))


def test_empty_table(spark):
    assert plain(ngram_join.near_duplicates(empty(spark))) == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    heavy = rng.random(1 << 20) < 0.7
    for _ in range(300):
        n = int(rng.integers(4, 400))
        one = shingles.distinct(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        lose = int(rng.integers(0, max(1, n // 9) + 1))
        other = np.delete(one, rng.choice(n, lose, replace=False))
        other = shingles.distinct(np.r_[other, rng.integers(0, 1 << 63, lose // 2, dtype=np.uint64) * np.uint64(2)])
        if ngram_join.linked(one, other) and one.tobytes() != other.tobytes():
            first, second = ngram_join.signatures(one, heavy)[0], ngram_join.signatures(other, heavy)[0]
            assert len(np.intersect1d(first, second))


def test_shingles_count_like_plain_python():
    rng = random.Random(2)
    texts = [None, "", " ", "a b", "x" * 500 + " y"]
    texts += ["".join(rng.choice("aBb é\n\t cA\x0b") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    found = {}
    for text, hashes in zip(texts, shingles.shingle_sets(pa.array(texts)), strict=True):
        expected = frozenset(plain_shingles(text))
        assert len(hashes) == len(expected)
        assert found.setdefault(expected, hashes.tobytes()) == hashes.tobytes()
    assert len(set(found.values())) == len(found)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 501), (501, 500), (7, 7)]
    found = dict(plain(components.connected(spark.createDataFrame(links, "a long, b long"))))
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[100 + i] == 100 for i in range(1, 200))
    assert found[501] == 500
