import random

import numpy as np
import pytest

from telemere.llm import weak_labels as wl
from tests.llm.data import documents, empty, plain


def good(rng):
    text = []
    for _ in range(rng.randint(2, 8)):
        sentence = [rng.choice(["the", "of", "a", "to"]) if rng.random() < 0.4 else "".join(rng.choices("abcdeilnorst", k=rng.randint(4, 9))) for _ in range(12)]
        text.append(" ".join(sentence).capitalize() + ".")
    return " ".join(text)


def poor(rng, kind):
    if kind == 0:
        return good(rng).upper().replace(" ", "!! ")
    if kind == 1:
        return " | ".join("".join(rng.choices("abcdeilnorst", k=7)) for _ in range(40))
    if kind == 2:
        return " ".join([w for w in "alpha beta gamma".split() for _ in range(20)])
    return " ".join("".join(rng.choices("abcdeilnorst", k=6)) + rng.choice(["***", "%%%", "$$$"]) for _ in range(40))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    rows = [(1000 + i, poor(rng, i % 4) if i % 5 == 0 else good(rng), "en", "s") for i in range(600)]
    return documents(spark, rows)


def test_poor_texts_are_found_without_labels(mixed):
    rows = {r.doc_id: r for r in wl.classify(mixed).collect()}
    wrong = [i for i in range(600) if rows[1000 + i].kept != (i % 5 != 0)]
    assert len(wrong) <= 12
    assert mixed.count() == wl.classify(mixed).count()


def test_awkward_texts(mixed):
    rows = {r.doc_id: r for r in wl.classify(mixed).collect()}
    assert rows[300].score == rows[301].score == rows[302].score == 0
    assert rows[0].score == rows[200].score  # equal texts


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.7
    accuracy = np.linspace(0.65, 0.95, wl.LABELLERS)
    right = rng.random((len(truth), wl.LABELLERS)) < accuracy
    vote = np.where(right, truth[:, None], ~truth[:, None]).astype(np.int64)
    vote[rng.random(vote.shape) < 0.3] = wl.SILENT
    numbers, times = np.unique(vote @ 3 ** np.arange(wl.LABELLERS), return_counts=True)
    model = wl.estimate(numbers, times.astype(float))
    assert model.good == pytest.approx(0.7, abs=0.03)
    for j in range(wl.LABELLERS):
        assert model.chance[wl.GOOD, j, wl.GOOD] == pytest.approx(accuracy[j], abs=0.05)


def test_counts_of_a_text():
    block = wl.read(["One two two. THREE | |", "", "a b c\n"])
    assert block.words.tolist() == [6, 0, 3] and block.distinct.tolist() == [5, 0, 3]
    assert block.repeated.tolist() == [1, 0, 0] and block.marks.tolist() == [2, 0, 0]


def test_empty_table(spark):
    assert plain(wl.classify(empty(spark))) == []
