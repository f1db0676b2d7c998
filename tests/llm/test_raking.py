import collections

import pytest

from telemere.llm import raking
from tests.llm.data import documents, empty, plain, words


@pytest.fixture(scope="module")
def corpus(spark):
    import random

    rng = random.Random(7)
    rows = []
    for i in range(900):
        source, lang = ("hot", "en") if i % 3 == 0 else (f"s{i % 5}", "de" if i % 4 == 0 else "en")
        text = words(rng, rng.randint(20, 60), lang) + ("  mail me at a@b.example" if i % 7 == 0 else "")
        rows.append((10_000 + i, text, lang, source))
    return documents(spark, rows)


@pytest.fixture(scope="module")
def mixed(corpus):
    return raking.mix(corpus).collect()


def brute_rates(cells, powers, share):
    """Plain iterative proportional fitting over a dict of cells."""
    total = sum(cells.values())
    rate = dict.fromkeys(cells, share)
    goals = []
    for m, name in enumerate(raking.MARGINS):
        sums = collections.Counter()
        for key, tokens in cells.items():
            sums[key[m]] += tokens
        whole = sum(v ** powers[name] for v in sums.values())
        goals.append({k: v ** powers[name] * total * share / whole for k, v in sums.items()})
    for _ in range(200):
        for m, goal in enumerate(goals):
            now = collections.Counter()
            for key in cells:
                now[key[m]] += rate[key] * cells[key]
            for key in cells:
                rate[key] *= goal[key[m]] / now[key[m]] if now[key[m]] else 1
        rate = {k: min(1, v) for k, v in rate.items()}
    return {k: r if cells[k] else 1.0 for k, r in rate.items()}


def test_rates_equal_plain_fitting(mixed):
    rows = mixed
    cells = collections.Counter()
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    expected = brute_rates(cells, raking.POWERS, raking.SHARE)
    for r in rows:
        key = (r.source, r.lang, r.topic)
        if cells[key]:
            assert r.rate == pytest.approx(expected[key], abs=0.02)


def test_kept_tokens_meet_the_targets(corpus, mixed):
    rows = mixed
    assert len(rows) == corpus.count()
    total = sum(r.n_tokens for r in rows if r.doc_id is not None and r.doc_id >= 10_000)
    kept = sum(r.n_tokens for r in rows if r.kept and r.doc_id is not None and r.doc_id >= 10_000)
    assert 0.25 * total < kept < 0.6 * total
    rate = {r.source: r.rate for r in rows}
    assert rate["hot"] < rate["s1"]


def test_sample_repeats_and_keeps_columns(corpus, mixed):
    rows = raking.sample(corpus)
    assert rows.columns == corpus.columns
    assert sorted(str(r.doc_id) for r in rows.collect()) == sorted(str(r.doc_id) for r in mixed if r.kept)


def test_awkward_rows(mixed):
    rows = {}
    for r in mixed:
        rows.setdefault(r.doc_id, []).append(r)
    (null,) = rows[300]
    assert (null.source, null.lang, null.n_tokens) == ("unknown", "unknown", 0)
    assert rows[302][0].n_tokens == 0 and rows[303][0].n_tokens == 2
    assert len({r.kept for r in rows[307]}) == 1 and len(rows[307]) == 2


def test_empty_table(spark):
    assert plain(raking.mix(empty(spark))) == []
    assert plain(raking.sample(empty(spark))) == []


def uneven(spark):
    """Cells in which a third of the tokens, of one source, face many small sources, mostly in other languages."""
    rows = [("hot", f"l{j}", t, 40_000 if j == 0 else 300, 9) for j in range(6) for t in ("prose", "table")]
    rows += [(f"s{i}", f"l{j}", "prose" if (i + j) % 3 else "table", 20 + 7 * ((i * j) % 90), 2)
             for i in range(700) for j in range(6) if (i + j) % 4]
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long, docs long")


@pytest.mark.parametrize("sent", [raking.CELLS_SENT, 0])
def test_feasible_targets_are_met_by_their_own_size(spark, sent):
    powers = {"source": 0.9, "lang": 0.5, "topic": 0.9}
    rated = raking.fit(uneven(spark), powers, 0.05, sent=sent).collect()
    total = sum(r.tokens for r in rated)
    for m in raking.MARGINS:
        have, got = collections.Counter(), collections.Counter()
        for r in rated:
            have[r[m]] += r.tokens
            got[r[m]] += r.rate * r.tokens
        whole = sum(v ** powers[m] for v in have.values())
        for k, v in have.items():
            goal = v ** powers[m] * total * 0.05 / whole
            assert goal > v or got[k] == pytest.approx(goal, rel=0.002), (m, k)


@pytest.mark.parametrize("sent", [raking.CELLS_SENT, 0])
def test_targets_that_are_not_met_are_reported(spark, sent):
    with pytest.warns(RuntimeWarning, match="off by"):
        raking.fit(uneven(spark), rounds=1, sent=sent)


def test_topics_look_at_whole_lines(spark):
    texts = {
        "table": [f"a | {'x' * 300} | y | z", "|| b |", f"|{'c ' * 5000}||"],
        "noise": [f"** {'x' * 90}** y** z", "&& ** %% "],
        "contact": [f"me@{'h' * 80}.example", "a.@my.host-name.example"],
        "prose": ["a | b\n| c", "** x ** y", "x" * 300_000, "** " + "x" * 300_000, "|" + "x" * 300_000],
    }
    rows = spark.createDataFrame([(t, k) for k, found in texts.items() for t in found], "text string, topic string")
    found = rows.select("topic", raking.topic(raking.F.col("text")).alias("found")).collect()
    assert [(r.topic, r.found) for r in found if r.topic != r.found] == []
