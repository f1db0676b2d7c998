"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

A chunk is a word with the space before it, as the tokenizer's pattern cuts a text.
An Aho-Corasick automaton over the byte strings of all tokens gives the longest token
at each position of a chunk; the encoder goes from left to right with longest matches,
takes a shorter one where two neighbouring tokens could not stand side by side in a
merged text, and steps back where none fits. Each position is left at most once for
good, so the work is linear in the chunk. Results equal those of merging by rank.
Ids of chunks, and of whole pieces between spaces, that came lately are kept in two tables of
at most ``2 * KEPT_CHUNKS`` entries and about ``2 * KEPT_BYTES`` bytes each. Workers keep them from
task to task, so these bounds are what a worker holds on any table, however many words it has.

Decoding joins the tokens' bytes, found by an offset table over one array of bytes.

Special tokens of the vocabulary file are matched in texts first. The vocabulary file
is read on the driver and sent to the tasks: its size is fixed.

Defined cases: null counts as empty, an empty text has no ids and decodes to an empty
text; extra columns may have any name.
"""

import functools
import hashlib
import json
from array import array
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from telemere.llm.tables import map_arrow

#: Entries and bytes of one half of a table of recent chunks, what an entry takes beside its characters and ids,
#: and of how many pairs of tokens it is kept whether they can stand side by side.
KEPT_CHUNKS = 100_000
KEPT_BYTES = 20 << 20
ENTRY_BYTES = 130
KEPT_PAIRS = 1 << 17
LONGEST_KEPT = 64

# White space of the Unicode standard, and the cut of a text into chunks (fixed values of the byte-level vocabulary).
SPACE = r"\t-\r \x85\xa0  -     　"
CHUNK = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_chars():
    """The character that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return [table[b] for b in range(256)]


@dataclass
class Vocabulary:
    tokens: list  # bytes of each id
    halves: dict  # id -> the pair of ids it is merged from
    order: dict  # id -> place of its merge, single bytes first
    special: dict  # text -> id

    @property
    def key(self):
        return id(self)


def load(path):
    """A vocabulary from a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    to_byte = {c: b for b, c in enumerate(byte_chars())}
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    tokens = [b""] * size
    for text, number in vocab.items():
        tokens[number] = bytes(to_byte[c] for c in text)
    for text, number in special.items():
        tokens[number] = text.encode()
    halves, order = {}, {}
    for place, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made = vocab[left + right]
        if made not in halves:
            halves[made] = (vocab[left], vocab[right])
            order[made] = place + 256
    return Vocabulary(tokens, halves, order, special)


class Recent:
    """A table of what was used lately: when the new half is full it becomes the old half."""

    def __init__(self):
        self.new, self.old, self.size = {}, {}, 0

    def older(self, key):
        """The value of a key that the new half lacks, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self.new) >= KEPT_CHUNKS or self.size >= KEPT_BYTES:
            self.new, self.old, self.size = {}, self.new, 0
        self.new[key] = value
        self.size += ENTRY_BYTES + 4 * len(key) + len(value)


class Encoder:
    """Encodes and decodes texts; one for each Python worker."""

    def __init__(self, vocabulary):
        self.tokens, self.halves, self.order = vocabulary.tokens, vocabulary.halves, vocabulary.order
        self.special = vocabulary.special
        usable = {n: t for n, t in enumerate(self.tokens) if t and (n in self.halves or len(t) == 1)}
        self.single = {t[0]: n for n, t in usable.items() if len(t) == 1}
        number = {t: n for n, t in usable.items()}
        self.automaton = ahocorasick.Automaton()
        # Tokens of frequent bytes come first: the automaton finds early branches of a node sooner.
        often = Counter(b for t in number for b in t)
        for t in sorted(number, key=lambda t: [-often[b] for b in t]):
            self.automaton.add_word(t.decode("latin-1"), (len(t), number[t]))
        self.automaton.make_automaton()
        self.merged = {pair: n for n, pair in self.halves.items()}
        # The longest token that a token begins with, itself left out.
        self.shorter = {}
        for t, n in number.items():
            self.shorter[n] = next((number[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in number), None)
        self.compatible = functools.lru_cache(maxsize=KEPT_PAIRS)(self._compatible)
        self.chunk = regex.compile(CHUNK)
        self.boundary = regex.compile(rf"(?<=.)(?= [^{SPACE}])", regex.S)
        self.odd_space = regex.compile(rf" (?:[{SPACE}]|\Z)")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.first, self.inner = Recent(), Recent()  # pieces between spaces, without and with a space before them
        self.length = [len(t) for t in self.tokens]
        size = np.array([len(t) for t in self.tokens], np.int64)
        self.offset = np.r_[0, np.cumsum(size)]
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.decimal = [str(n) for n in range(len(self.tokens))]

    def _rank(self, n):
        return self.order.get(n, -1)

    def _compatible(self, left, right):
        """Whether two tokens can stand side by side: no merge across their border comes early enough.

        The border pair is followed down the merge trees of both tokens, undoing the
        later merge first; a border merge that comes before the merges it would have
        pre-empted means that the two tokens never arise side by side.
        """
        order, halves = self.order, self.halves
        limit = len(self.tokens) + 256
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and order[joint] < limit:
                return False
            a, b = order.get(left, -1), order.get(right, -1)
            if a < 0 and b < 0:
                return True
            # Undo the merge that came last. A border merge of equal order with the left one
            # would have gone first, being further left only if it starts inside the left token.
            if a > b:
                limit, left = min(limit, a), halves[left][1]
            else:
                limit, right = min(limit, b + 1), halves[right][0]

    def _ids(self, data):
        """Token ids of one chunk's bytes."""
        text = data.decode("latin-1")
        if len(data) <= LONGEST_KEPT:
            # Longest matches from left to right are mostly compatible as they are.
            ids = [token for _, (_, token) in self.automaton.iter_long(text)]
            if all(map(self.compatible, ids, ids[1:])):
                return ids
        n = len(data)
        longest = [None] * n
        size = [0] * n
        for end, (length, token) in self.automaton.iter(text):
            start = end - length + 1
            if length > size[start]:
                size[start], longest[start] = length, token
        open_at = bytearray(b"\x01") * (n + 1)
        ids, at, token, last = [], 0, longest[0], None
        lengths, shorter, compatible = self.length, self.shorter, self.compatible
        while at < n:
            while token is not None:
                end = at + lengths[token]
                if open_at[end] and (last is None or compatible(last, token)):
                    break
                token = shorter[token]
            if token is not None:
                ids.append(token)
                at, last = end, token
                token = longest[at] if at < n else None
            else:
                open_at[at] = 0
                token = ids.pop()
                at -= lengths[token]
                last = ids[-1] if ids else None
        return ids

    def _chunk_ids(self, text):
        """Ids of a run of chunks as bytes of int32."""
        chunks = self.chunk.findall(text)
        if len(chunks) == 1:
            return array("i", self._ids(text.encode("utf-8"))).tobytes()
        parts = []
        for chunk in chunks:
            store, piece = (self.inner, chunk[1:]) if chunk[0] == " " else (self.first, chunk)
            ids = store.new.get(piece) or store.older(piece)
            if ids is None:
                ids = array("i", self._ids(chunk.encode("utf-8"))).tobytes()
                if len(piece) <= LONGEST_KEPT:
                    store.put(piece, ids)
            parts.append(ids)
        return b"".join(parts)

    def _piece(self, store, piece, space):
        """Ids of a piece that the new half of ``store`` lacks."""
        made = store.older(piece)
        if made is None:
            made = self._chunk_ids(" " + piece if space else piece)
            if len(piece) <= LONGEST_KEPT:
                store.put(piece, made)
        return made

    def _plain(self, text):
        if self.odd_space.search(text):
            # A space before anything but white space always begins a chunk.
            store = self.first
            return [store.new.get(p) or self._piece(store, p, False) for p in self.boundary.split(text) if p]
        head, *rest = text.split(" ")
        store = self.inner
        get = store.new.get
        found = [get(p) for p in rest]
        if None in found:
            found = [f or store.new.get(p) or self._piece(store, p, True) for f, p in zip(found, rest, strict=True)]
        if head:
            found.insert(0, self.first.new.get(head) or self._piece(self.first, head, False))
        return found

    def encode(self, text):
        """Ids of a whole text as an int32 array."""
        if not text:
            return np.zeros(0, np.int32)
        if self.marks is None or not any(mark in text for mark in self.special):
            return np.frombuffer(b"".join(self._plain(text)), np.int32)
        parts = []
        for piece in self.marks.split(text):
            if piece in self.special:
                parts.append(np.int32(self.special[piece]).tobytes())
            elif piece:
                parts += self._plain(piece)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids):
        """Bytes of ids, by the offset table."""
        if not len(ids):
            return b""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        place = np.arange(end[-1]) + np.repeat(start - (end - size), size)
        return self.bytes[place].tobytes()

    def text(self, ids):
        """The text of ids, with U+FFFD for bytes that are no UTF-8."""
        return self.decode(ids).decode("utf-8", "replace")

    def joined(self, ids):
        return ",".join(map(self.decimal.__getitem__, ids.tolist()))


_encoders = {}


def _encoder(shared):
    """The worker's encoder of a broadcast vocabulary."""
    vocabulary = shared.value
    if vocabulary.key not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.key] = (vocabulary, Encoder(vocabulary))
    return _encoders[vocabulary.key][1]


def encode(docs, path):
    """One row per document: doc_id and ids, the token ids of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = pa.array([encoder.encode(t or "") for t in texts], pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), ids], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decode(tokens, path):
    """One row per row of ``tokens``: doc_id and the text of its ids."""
    shared = tokens.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [encoder.text(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(tokens.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs, path):
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes in the same task, so neither ids nor texts travel.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            rows = [[], [], []]
            for t in batch.column(1):
                ids = encoder.encode(t.as_py() or "")
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(encoder.joined(ids).encode()).hexdigest())
                rows[2].append(hashlib.sha256(encoder.text(ids).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(rows[0], pa.int64()), *(pa.array(r, pa.string()) for r in rows[1:])],
                names=names,
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
