"""Quality scores from weak labels.

Heuristic labellers look at a whole text and vote that it is good, poor, or not at all.
Expectation-maximisation estimates, without any given label, how often each vote falls on
good and on poor texts (its accuracy) and the share of good texts; it runs on counts of
vote patterns over all documents, at most 3 ** labellers of them. The posterior of a pattern
is the soft label of its documents; a silent labeller says nothing. With those labels a logistic scorer over hashed
features of the text is trained on at most ``max_docs`` documents chosen by hash, and that
scorer scores every whole text. It sees what the labellers only count: which signs, letter
cases and repeated words follow each other.

Defined cases: a null or empty text has no feature and gets score 0; equal texts get equal scores;
rows that repeat an id are scored each; extra columns may have any name; an empty table
gives an empty result.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from telemere.llm.tables import map_arrow
from telemere.llm.textblocks import blocks, codes

GOOD, POOR, SILENT = 1, 0, 2
FEATURES = 1 << 12
#: Kinds of characters; signs of their own kind are those that poor texts are rich in (fixed list of this library).
SPACE, LOWER, UPPER, DIGIT, STOP, COMMA, OTHER = range(7)
SIGNS = "|*%$&#!@<>{}[]=_~^+/\\"
KINDS = 7 + len(SIGNS)
REPEATED = KINDS  # a word equal to the one before it


@functools.cache
def _kinds():
    table = np.full(1 << 16, OTHER, np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isspace():
            table[code] = SPACE
        elif char.isupper():
            table[code] = UPPER
        elif char.isalpha():
            table[code] = LOWER
        elif char.isdigit():
            table[code] = DIGIT
    for char in ".?…。":
        table[ord(char)] = STOP
    for char in ",;:":
        table[ord(char)] = COMMA
    for number, char in enumerate(SIGNS):
        table[ord(char)] = 7 + number
    return table


@dataclass
class Block:
    kind: np.ndarray  # kind of each character
    text: np.ndarray  # text of each character
    words: np.ndarray  # words of each text
    distinct: np.ndarray  # distinct words of each text
    short: np.ndarray  # words of at most three characters that begin with a letter
    marks: np.ndarray  # words of at most two characters that begin with a sign
    repeated: np.ndarray  # words equal to the one before
    counts: np.ndarray  # characters of each text by kind


def read(texts):
    """Counts of a run of texts."""
    n = len(texts)
    array, ends = codes(texts)
    kind = _kinds()[np.minimum(array, 0xFFFF)]
    text = np.repeat(np.arange(n), np.diff(np.r_[0, ends]))
    counts = np.bincount(text * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS)
    solid = kind != SPACE
    first = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    last = np.flatnonzero(solid & np.r_[~solid[1:], True]) + 1
    owner = text[first]
    base = np.full(max(len(array) - 1, 0), 0x9E3779B97F4A7C15, np.uint64)
    power = np.cumprod(np.r_[np.uint64(1), base], dtype=np.uint64)
    # A word's hash: a polynomial in its characters, brought to the same power for all words.
    value = array.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    sums = np.r_[np.uint64(0), np.cumsum(value * power[::-1], dtype=np.uint64)]
    word = (sums[last] - sums[first]) * power[first] if len(first) else np.zeros(0, np.uint64)
    again = np.zeros(len(first), bool)
    if len(first) > 1:
        again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    words = np.bincount(owner, minlength=n)
    distinct = np.zeros(n, np.int64)
    at = np.r_[0, np.cumsum(words)]
    for i in range(n):
        if words[i]:
            own = np.sort(word[at[i] : at[i + 1]])
            distinct[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    return Block(
        kind,
        text,
        words,
        distinct,
        np.bincount(owner[(last - first <= 3) & ((kind[first] == LOWER) | (kind[first] == UPPER))], minlength=n),
        np.bincount(owner[(last - first <= 2) & (kind[first] >= 7)], minlength=n),
        np.bincount(owner[again], minlength=n),
        counts,
    )


def _vote(value, poor, good):
    """POOR where ``poor``, else GOOD where ``good``, else SILENT."""
    return np.where(poor, POOR, np.where(good, GOOD, SILENT)).astype(np.int8)


def votes(block):
    """Votes [text, labeller]."""
    words = np.maximum(block.words, 1)
    c = block.counts
    letters = np.maximum(c[:, LOWER] + c[:, UPPER], 1)
    shout = c[:, UPPER] / letters
    signs = c[:, 7:].sum(axis=1) / words
    stops = c[:, STOP] / words
    root = np.sqrt(words)
    solid = np.maximum(c.sum(axis=1) - c[:, SPACE], 1)
    return np.stack(
        [
            _vote(shout, shout > 0.4, (shout < 0.15) & (block.words >= 10)),
            _vote(signs, signs > 0.25, signs < 0.02),
            _vote(words, block.distinct < 2.5 * root, block.distinct > 4 * root),
            _vote(words, block.repeated > 0.15 * words, block.repeated < 0.03 * words),
            _vote(stops, (stops < 0.01) & (block.words >= 40), (stops > 0.03) & (stops < 0.4)),
            _vote(words, block.words < 3, block.words >= 20),
            _vote(words, (block.short < 0.1 * words) & (block.words >= 20), block.short > 0.2 * words),
            _vote(words, block.marks > 0.15 * words, (block.marks < 0.01 * words) & (block.words >= 10)),
            _vote(letters, letters < 0.6 * solid, letters > 0.85 * solid),
        ],
        axis=1,
    )


LABELLERS = 9


def patterns(block):
    """Each text's votes as one number."""
    return votes(block).astype(np.int64) @ (3 ** np.arange(LABELLERS))


def _digits(numbers):
    return (numbers[:, None] // 3 ** np.arange(LABELLERS)) % 3


def features(block, n):
    """Hashed features [text, FEATURES]: how often each run of three kinds occurs, as roots of shares."""
    kind = block.kind.astype(np.int64)
    run = kind.copy()
    run[1:] += kind[:-1] * 32
    run[2:] += np.where(block.text[2:] == block.text[:-2], kind[:-2], SPACE) * 1024  # a line feed ends each text
    slot = (run * 2654435761 >> 7) % (FEATURES - 2) + 2
    counts = np.bincount(block.text * FEATURES + slot, minlength=n * FEATURES).reshape(n, FEATURES).astype(np.float32)
    counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
    words = np.maximum(block.words, 1)
    counts[:, 0] = block.repeated / words
    counts[:, 1] = np.minimum(1, block.distinct / np.sqrt(words) / 10)
    return np.sqrt(counts)


def _texts(column):
    return [t or "" for t in column.to_pylist()]


def _count_rows(batches):
    sums = {}
    for batch in batches:
        texts = _texts(batch.column(0))
        for lo, hi in blocks(texts):
            number, times = np.unique(patterns(read(texts[lo:hi])), return_counts=True)
            for p, k in zip(number.tolist(), times.tolist(), strict=True):
                sums[p] = sums.get(p, 0) + k
    columns = [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())]
    yield pa.record_batch(columns, names=["pattern", "n"])


@dataclass
class Accuracies:
    good: float  # share of good texts
    chance: np.ndarray  # [class, labeller, vote]: how often a labeller that votes gives this vote on texts of a class

    def posterior(self, numbers):
        """How likely texts with these vote patterns are good."""
        given = _digits(np.asarray(numbers))
        log = np.stack(
            [
                np.log(share)
                + sum(np.where(given[:, j] == SILENT, 0, np.log(self.chance[k, j, given[:, j]])) for j in range(LABELLERS))
                for k, share in ((POOR, 1 - self.good), (GOOD, self.good))
            ]
        )
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def estimate(numbers, times, rounds=200, tolerance=1e-7):
    """Expectation-maximisation over vote patterns and how many documents have each.

    Starts from the majority of votes, and takes labellers to be better than chance there.
    """
    given = _digits(numbers)
    for_good, for_poor = (given == GOOD).sum(axis=1), (given == POOR).sum(axis=1)
    belief = (for_good + 1.0) / (for_good + 2.0 * for_poor + 2.0)
    model = None
    for _ in range(rounds):
        good = float(np.clip((belief * times).sum() / times.sum(), 0.01, 0.99))
        chance = np.empty((2, LABELLERS, 3))
        for k, weight in ((POOR, (1 - belief) * times), (GOOD, belief * times)):
            for j in range(LABELLERS):
                held = np.bincount(given[:, j], weight, 3) + 0.5
                held[SILENT] = 0
                chance[k, j] = np.maximum(held / held.sum(), 1e-9)
        model = Accuracies(good, chance)
        now = model.posterior(numbers)
        moved = np.abs(now - belief).max()
        belief = now
        if moved < tolerance:
            break
    return model


def label(docs):
    """The labellers' accuracies, from the vote patterns of all documents."""
    rows = map_arrow(docs.select("text"), _count_rows, "pattern long, n long")
    found = rows.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toArrow()
    if not found.num_rows:
        return Accuracies(0.5, np.full((2, LABELLERS, 3), 1 / 3))
    return estimate(np.array(found.column(0)), np.array(found.column(1), np.float64))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def probability(self, texts):
        """How likely each text is good; 0 for texts without a character."""
        out = np.zeros(len(texts))
        for lo, hi in blocks(texts):
            for a in range(lo, hi, 512):
                part = texts[a : min(a + 512, hi)]
                block = read(part)
                raw = features(block, len(part)) @ self.weights + self.bias
                out[a : a + len(part)] = np.where(block.words > 0, 1 / (1 + np.exp(-np.clip(raw, -30, 30))), 0.0)
        return out


def _feature_rows(model):
    def run(batches):
        for batch in batches:
            texts = _texts(batch.column(0))
            for lo, hi in blocks(texts):
                for a in range(lo, hi, 512):
                    part = texts[a : min(a + 512, hi)]
                    block = read(part)
                    x = features(block, len(part)).astype(np.float16)
                    yield pa.record_batch(
                        [
                            pa.array([row.tobytes() for row in x], pa.binary()),
                            pa.array(model.posterior(patterns(block))),
                        ],
                        names=["x", "good"],
                    )

    return run


def fit(docs, model, max_docs=4000, rounds=300, ridge=1e-4):
    """Train the hashed linear scorer on posterior labels."""
    ids = docs.select(F.xxhash64(F.col("doc_id").cast("string")).alias("h")).orderBy("h").limit(max_docs)
    edge = ids.agg(F.max("h")).first()[0]
    if edge is None:
        return Scorer(np.zeros(FEATURES, np.float32), 0.0)
    sample = docs.filter(F.xxhash64(F.col("doc_id").cast("string")) <= edge).select("text")
    # Rows that repeat an id share its hash; the limit holds for them too.
    rows = map_arrow(sample, _feature_rows(model), "x binary, good double").limit(2 * max_docs).toArrow()
    x = np.frombuffer(b"".join(rows.column(0).to_pylist()), np.float16).reshape(-1, FEATURES).astype(np.float32)
    y = np.array(rows.column(1), np.float32)
    # Both classes weigh the same, so rare poor texts count.
    weight = np.where(y >= 0.5, 0.5 / max((y >= 0.5).sum(), 1), 0.5 / max((y < 0.5).sum(), 1)).astype(np.float32)
    w, bias = np.zeros(FEATURES, np.float32), np.float32(0)
    step_w, step_b = np.full(FEATURES, 1e-8, np.float32), np.float32(1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        error = weight * (p - y)
        gradient, gradient_b = x.T @ error + ridge * w, error.sum()
        step_w, step_b = step_w + gradient**2, step_b + gradient_b**2
        w, bias = w - gradient / np.sqrt(step_w), bias - gradient_b / np.sqrt(step_b)
    return Scorer(w, float(bias))


def score(docs, scorer, threshold=0.5):
    """One row per document: doc_id, score, quality (1 good, 0 poor) and kept."""

    def run(batches):
        for batch in batches:
            p = scorer.probability(_texts(batch.column(1)))
            yield pa.record_batch(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(p >= threshold)],
                names=["doc_id", "score", "quality", "kept"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(rows, run, "doc_id long, score double, quality int, kept boolean")


def classify(docs, max_docs=4000, threshold=0.5):
    """Label, train and score in one go."""
    model = label(docs)
    return score(docs, fit(docs, model, max_docs), threshold)
