import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from telemere.llm import bpe
from tests.llm.data import documents, empty, plain

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def random_texts(n):
    rng = random.Random(3)
    signs = "abcdefghij  \n\t'stremld.,!?0123 éüñß漢字🙂  \x1c\x85|<>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["<|endoftext|>", "a<|endoftext|> b <|endoftext|>c", "  ", "\n\n a", " a ", "a" * 3000, " " * 300]


def test_equals_the_library_and_round_trips(library):
    encoder = bpe.Encoder(bpe.load(PATH))
    for text in random_texts(3000):
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.text(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 5)
    encoder = bpe.Encoder(bpe.load(PATH))
    for text in random_texts(300):
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("word", "ids"), [("w", 8), ("漢字かな交じり文書" * 6, 4 * 60)])
def test_what_a_worker_keeps_is_bounded_on_any_words(word, ids):
    store = bpe.Recent()
    tracemalloc.start()
    try:
        for i in range(550_000):
            store.put(f"{word}{i}", bytes(ids))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 50 << 20


def test_bounds_in_bytes_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 2_000)
    encoder = bpe.Encoder(bpe.load(PATH))
    for text in random_texts(300):
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(len(s.new) + len(s.old) for s in (encoder.first, encoder.inner)) < 60


def test_backtracking_alone_is_exact(library):
    encoder = bpe.Encoder(bpe.load(PATH))
    rng = random.Random(9)
    for _ in range(3000):
        chunk = "".join(rng.choice("thersonaingedtiu") for _ in range(rng.randint(1, 100)))
        assert encoder._ids(chunk.encode()) == library.encode(chunk, add_special_tokens=False).ids


def test_digests_of_a_table(spark, library):
    docs = documents(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    result = bpe.digests(docs, PATH).collect()
    assert len(result) == docs.count()
    for r in result:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_tables_of_ids_decode(spark):
    docs = documents(spark)
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted(
        (str(r.doc_id), r.text or "") for r in docs.collect()
    )


def test_empty_table(spark):
    assert plain(bpe.digests(empty(spark), PATH)) == []


def test_decoding_broken_bytes():
    encoder = bpe.Encoder(bpe.load(PATH))
    assert encoder.text(np.array([encoder.single[0xE9]])) == "�"
