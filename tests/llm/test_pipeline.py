import os

import pytest

import corpus_pipeline
from telemere.llm import queries, string_kernel
from telemere.llm.tables import kept, table
from tests.llm.data import shingles

SF = os.environ.get("TELEMERE_TEST_LLM_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_stages_against_their_contracts(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, kept(stage(spark, docs, SF), name)
        seen[name] = (before.select("doc_id", "text").collect() if "text" in before.columns else [], docs.collect())
        if name != "bpe":
            assert docs.columns == before.columns

    before, after = seen["toxicity"]
    marks = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    # Some forty toxic documents in four languages teach only the words that they hold.
    toxic, clean = ({i for i, m in marks.items() if m == mark} for mark in (1, 0))
    assert len(gone & toxic) >= 0.6 * len(toxic) and len(gone & clean) <= 0.05 * len(clean)

    before, after = seen["exact_dedup"]
    largest = {}
    for r in before:
        largest[r.text or ""] = max(largest.get(r.text or "", -1), r.doc_id)
    assert {r.doc_id for r in after} == set(largest.values())

    before, after = seen["ngram_join"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            same = len(sets[i] & sets[j])
            if same and 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    assert {r.doc_id for r in after} == {find(i) for i in ids}

    before, after = seen["mixing"]
    assert 0 < len(after) < len(before)
    before, after = seen["bpe"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}


def test_run_gives_the_last_stage(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and result.count() > 0


def test_held_out_toxicity(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = queries.QUERIES["op7_toxicity"](spark, SF).join(labels, "doc_id").collect()
    assert docs.count() == queries.QUERIES["op7_toxicity"](spark, SF).count()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.85 * len(held)
    assert string_kernel.trainable(labels).count() == labels.count() - len(held)
