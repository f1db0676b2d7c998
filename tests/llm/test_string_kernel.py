import itertools
import random

import numpy as np
import pytest

from telemere.llm import string_kernel as sk
from telemere.llm.textblocks import codes
from tests.llm.data import documents, empty, plain, words

INSULTS = ["idiot", "worthless", "disgusting", "pathetic"]


def brute_kernel(a, b):
    """The kernel from its definition, over strings with their edges marked."""

    def parts(word):
        framed = f"^{word}$"
        found = {}
        for i, j, k in itertools.combinations(range(len(framed)), 3):
            if k - i < sk.MAX_SPAN:
                key = framed[i] + framed[j] + framed[k]
                found[key] = found.get(key, 0) + sk.DECAY ** (k - i + 1)
        return found

    def term(word):
        return sk.length_term(np.array([len(word) + 2]))[0]

    x, y = parts(a), parts(b)
    return sum(v * y.get(k, 0) for k, v in x.items()) / term(a) / term(b)


def word(text):
    (found,) = sk.words_of([text])
    (only,) = found
    return only


@pytest.mark.parametrize("pair", [("idiot", "idiot"), ("idiot", "idxiot"), ("banana", "bandana"), ("abc", "xyz"), ("a", "a")])
def test_kernel_follows_its_definition(pair):
    a, b = pair
    assert sk.kernel([word(a)], [word(b)])[0, 0] == pytest.approx(brute_kernel(a, b), rel=1e-5)


def test_units_join_what_evasions_split():
    same = [word(t) for t in ("idiot", "i d i o t", "i-d-i-o-t", "1d1ot", "i.d.i.o.t!")]
    assert len(set(same)) == 1


def test_long_units_count_by_windows():
    rng = random.Random(1)
    filler = "".join(rng.choice("bcfgh") for _ in range(5000))
    table = np.zeros(sk.CLASSES**3, np.float32)
    slots, tables = sk._landmark_tables([word("idiot")])
    table[slots] = tables[0]
    units = sk.units_of(codes([filler + "idiot" + filler])[0])
    assert sk.unit_scores(units, table)[0] > 3 * sk.unit_scores(sk.units_of(codes([filler])[0]), table)[0]


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        text = words(rng, 40).split()
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(INSULTS)
        rows.append((10_000 + i, " ".join(text), "en", "s"))
        marks.append((10_000 + i, None if i % 50 == 1 else int(i % 4 == 0), 0))
    marks += [(None, 1, 0), (99, 1, 0), (10_002, 0, 0)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    return docs, labels, sk.fit(docs, sk.trainable(labels), max_docs=200, n_landmarks=32)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    seen = sk.trainable(labels).select("doc_id")
    held = labels.filter("toxic IS NOT NULL").join(seen, "doc_id", "left_anti").select("doc_id", "toxic")
    rows = sk.classify(docs, model).join(held, "doc_id").collect()
    assert len(rows) > 60 and sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)


def test_evasions_and_awkward_texts(trained):
    _, _, model = trained
    texts = ["you i d i o t", "w-o-r-t-h-l-e-s-s thing", "so disxgusting", "the thing of reason", "", " ", "x" * 100_000]
    p = model.probability(sk.raw_scores(texts, model))
    assert all(p[:3] >= 0.3) and all(p[3:] < 0.3)
    assert p[4] == p[5] == model.probability(model.floor)


def test_reject_keeps_rows_and_columns(trained):
    docs, _, model = trained
    left = sk.reject(docs, model)
    assert left.columns == docs.columns
    gone = {str(r.doc_id) for r in docs.collect()} - {str(r.doc_id) for r in left.collect()}
    assert gone == {str(r.doc_id) for r in sk.classify(docs, model).collect() if r.predicted == 1}


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = sk.fit(documents(spark), none)
    assert all(r.predicted == 0 for r in sk.classify(documents(spark), model).collect())
    assert plain(sk.classify(empty(spark), model)) == []
    assert plain(sk.classify(empty(spark), sk.fit(empty(spark), none))) == []


def test_letters_join_over_any_signs_and_blanks():
    same = [word(t) for t in ("idiot", "i - d - i - o - t", "i   d   i   o   t", "i\n\n.. d * i ** o  t", "𝐢𝐝𝐢𝐨𝐭")]
    assert len(set(same)) == 1
    assert [len(bag) for bag in sk.words_of(["an i", "d an"])] == [2, 2]


def test_short_words_are_scored_as_runs(trained):
    _, _, model = trained
    texts = ["you wort hless one", "you path etic", "you are so dis gust ing now", "the thing of the reason and on it er on"]
    p = model.probability(sk.raw_scores(texts, model))
    assert all(p[:3] >= 0.3) and p[3] < 0.3
