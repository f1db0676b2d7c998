import itertools
import random

import numpy as np
import pytest

from telemere.llm import lang_spans
from tests.llm.data import documents, empty, plain, words


@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(6)
    rows = [(5000 + i, words(rng, 50, lang), lang, "s") for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(9000 + i, "привет мир это слово " * 5, "ru", "s") for i in range(9)]
    docs = documents(spark, rows)
    return docs, lang_spans.fit(docs)


def brute_path(scores, penalty):
    n, k = scores.shape
    return max(
        sum(scores[i, path[i]] for i in range(n)) - penalty * sum(a != b for a, b in itertools.pairwise(path))
        for path in itertools.product(range(k), repeat=n)
    )


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(2)
    lengths = np.array([6, 0, 1, 7, 3])
    scores = rng.normal(size=(lengths.sum(), 3)) * 3
    starts = np.cumsum(lengths) - lengths
    label = lang_spans.viterbi(scores.astype(np.float32), starts, lengths, 2.0)
    for s, n in zip(starts, lengths, strict=True):
        if n:
            path = label[s : s + n]
            got = scores[np.arange(s, s + n), path].sum() - 2.0 * (path[1:] != path[:-1]).sum()
            assert got == pytest.approx(brute_path(scores[s : s + n], 2.0), abs=1e-4)


def test_held_out_accuracy(spark, taught):
    docs, _ = taught
    model = lang_spans.fit(lang_spans.trainable(docs))
    known = docs.filter("doc_id >= 5000").select("doc_id", "lang")
    held = known.join(lang_spans.trainable(known).select("doc_id"), "doc_id", "left_anti")
    rows = lang_spans.identify(docs, model).join(held, "doc_id").collect()
    assert len(rows) > 20 and all(r.lang_pred == r.lang for r in rows)


def test_awkward_texts(taught):
    docs, model = taught
    rows = {r.doc_id: r for r in lang_spans.identify(docs, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (300, 301, 302))
    assert rows[305].lang_pred == "de" and all(0 <= r.score <= 1 for r in rows.values())
    assert lang_spans.identify(docs, model).count() == docs.count()


def test_mixed_text_has_spans(taught):
    _, model = taught
    rng = random.Random(1)
    english, german = words(rng, 12), words(rng, 12, "de")
    found = lang_spans.text_spans(f"{english}. {german}. привет мир", model)
    assert [lang for _, _, lang in found] == ["en", "de", "ru"]
    assert found[0][:2] == (0, len(english))


def test_scripts_narrow_candidates(taught):
    _, model = taught
    assert lang_spans.label_texts(["мир"], model)[0] == ["ru"]
    assert lang_spans.label_texts(["漢字"], model)[0][0] in model.languages


def test_no_rows_and_nothing_learnt(spark):
    model = lang_spans.fit(empty(spark))
    assert plain(lang_spans.identify(empty(spark), model)) == []
    assert {r.lang_pred for r in lang_spans.identify(documents(spark), model).collect()} == {"und"}


def test_more_languages_than_a_byte_counts():
    n = 300
    scores = np.full((n, n), -20.0, np.float32)
    scores[np.arange(n), np.arange(n)] = 0.0
    label = lang_spans.viterbi(scores, np.array([0]), np.array([n]), 1.0)
    assert label.tolist() == list(range(n))


def test_emoji_are_no_letters(taught):
    _, model = taught
    assert lang_spans.label_texts(["🙂🙃 🎉"], model) == (["und"], [0.0])
    words = lang_spans.words_of(lang_spans.codes(["ab🙂 𝐜𝐝 𠀀"])[0])
    assert words.length.tolist() == [2, 2, 1]
