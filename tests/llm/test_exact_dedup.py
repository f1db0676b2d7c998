import hashlib

from telemere.llm import bloom, exact_dedup
from telemere.llm.tables import drop_ids
from tests.llm.data import documents, empty, plain


def groups(rows):
    found = {}
    for i, text in rows:
        found.setdefault(text or "", []).append(i)
    return found


def test_flags_follow_the_contract(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    held = groups(rows)
    result = exact_dedup.flag_duplicates(docs).collect()
    assert len(result) == len(rows)
    for text, ids in held.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        own = [r for r in result if r.text_sha256 == digest]
        assert sorted(str(r.doc_id) for r in own) == sorted(map(str, ids))
        assert {r.keep_id for r in own} == {max((i for i in ids if i is not None), default=None)}
        assert {r.group_size for r in own} == {len(ids)}
        assert sum(r.kept for r in own) == 1
        assert all(r.doc_id == r.keep_id for r in own if r.kept)


def test_rows_that_stay_are_unchanged(spark):
    docs = documents(spark)
    stay = exact_dedup.drop_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(r.text or "" for r in stay.collect()) == sorted({r.text or "" for r in docs.collect()})


def test_a_group_that_holds_most_rows(spark):
    docs = documents(spark, [(i, "same text", "en", "hot") for i in range(1000, 4000)])
    result = exact_dedup.flag_duplicates(docs).filter("group_size = 3000").collect()
    assert len(result) == 3000 and [r.doc_id for r in result if r.kept] == [3999]


def test_empty_table(spark):
    assert plain(exact_dedup.flag_duplicates(empty(spark))) == []
    assert plain(exact_dedup.drop_duplicates(empty(spark))) == []


def test_bloom_filter_never_misses(spark):
    keys = spark.range(5000).withColumnRenamed("id", "key")
    bits = bloom.filter_bits(5000)
    flagged = bloom.probe(keys, bloom.members(keys.filter("key % 7 = 0"), "key", bits), keys["key"], bits, "hit")
    rows = flagged.collect()
    assert len(rows) == 5000 and all(r.hit for r in rows if r.key % 7 == 0)
    assert sum(r.hit for r in rows if r.key % 7) < 100


def test_filter_size_is_bounded():
    assert bloom.filter_bits(10**12) == bloom.MAX_BITS


def test_drop_ids(spark):
    docs = documents(spark)
    left = drop_ids(docs, spark.createDataFrame([(1,), (307,)], "doc_id long"))
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(r.doc_id) for r in docs.collect() if r.doc_id not in (1, 307)
    )
