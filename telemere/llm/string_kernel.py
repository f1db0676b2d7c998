"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel with Nyström landmarks.

A *unit* is a word reduced to letters: digits that stand for letters are read as
those, mathematical and full-width letters as plain ones, every other sign inside a word is
dropped, and neighbouring single letters ("i d i o t", "i - d - i - o - t") of a text join to one
unit, whatever stands between them. A run of neighbouring words of at most ``SHORT`` letters ("id iot") is scored
again by twos and threes, with the blanks as gap letters. The kernel of two units compares their subsequences of
three letters that span at most ``MAX_SPAN`` letters, each weighted ``DECAY ** span``,
so "idxiot" and "i-d-i-o-t" stay near "idiot"; it is divided by a length term, which
keeps it positive definite. Units longer than ``WINDOW`` letters count by overlapping
windows. The whole score of a unit is then a sum over its subsequences of one trained
table, and no list of landmarks is walked for a document.

Training uses sentences of at most ``max_docs`` labelled documents a class and at most
``max_sentences`` sentences, chosen by hash. A document's label only says that some
sentence is toxic, so the toxic sentences and their witness units are chosen again
after each fit. A document's score is that of its highest unit, calibrated on the
labelled documents of the sample.

Defined cases: null and empty texts have no unit and get the lowest score; labels that
are null, or whose document is missing, are not used; several labels of a document
count as toxic if one is. Without labels of both classes every score is the share of
toxic labels, 0 if there is none. Extra columns of any name pass through ``score``.
"""

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemere.llm.tables import map_arrow
from telemere.llm.textblocks import blocks, codes

DECAY = 0.7
MAX_SPAN = 5
WINDOW = 24
CLASSES = 64
#: Training also takes toxic units of at least so many letters and marks with one letter put in, at this weight.
MIN_BROKEN = 7
KERNEL_ROWS = 256
BROKEN_WEIGHT = 0.1
#: (offset of the second letter, offset of the third letter) of each subsequence.
PATTERNS = [(a, b) for b in range(2, MAX_SPAN) for a in range(1, b)]

# Digits and signs read as letters (fixed values).
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}

BREAK, DROPPED = 254, 255
#: Words of at most so many letters are also scored as a run, with this class for the blanks between them.
SHORT = 5
GAP = 63


@functools.cache
def _letter_classes():
    """Code point -> letter class 1..62 (0 marks a unit's edges, GAP a blank), BREAK for white space, DROPPED for the rest."""
    table = np.full(1 << 16, DROPPED, np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        if char.isspace():
            table[code] = BREAK
        elif "a" <= char <= "z":
            table[code] = code - 96
        elif char.isalpha():
            table[code] = 27 + code % 36
    for sign, letter in LOOKALIKES.items():
        table[ord(sign)] = ord(letter) - 96
    return table


@functools.cache
def _class_above(code):
    """Letter class of a code point above U+FFFF."""
    plain = unicodedata.normalize("NFKC", chr(code)).lower()
    if len(plain) == 1 and ord(plain) <= 0xFFFF:
        return int(_letter_classes()[ord(plain)])
    return 27 + code % 36 if chr(code).isalpha() else DROPPED


@dataclass
class Units:
    letters: np.ndarray  # letter classes of all units, one after the other, each between two edge marks
    start: np.ndarray  # the mark before each unit
    length: np.ndarray
    place: np.ndarray  # position in the code array of each unit's first letter


def units_of(array, ends=None):
    """The units of a code array of lower-cased texts that end in white space; without ``ends`` it is one text."""
    table = _letter_classes()
    kind = table[np.minimum(array, 0xFFFF)]
    above = np.flatnonzero(array > 0xFFFF)
    if len(above):  # read as the letters that they stand for, once for each distinct code point
        points, which = np.unique(array[above], return_inverse=True)
        kind[above] = np.array([_class_above(c) for c in points.tolist()], np.uint8)[which]
    at = np.flatnonzero(kind != DROPPED)
    kind = kind[at]
    gap = kind == BREAK
    word = np.cumsum(gap)[~gap]  # which run of letters each letter is of
    letters, at = kind[~gap], at[~gap]
    if not len(letters):
        none = np.zeros(0, np.int64)
        return Units(letters, none, none, none)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    single = np.diff(np.r_[first, len(letters)]) == 1
    # Whatever stands between two single letters joins them, unless the text ends there.
    owner = np.zeros(len(first), np.int64) if ends is None else np.searchsorted(ends, at[first], "right")
    merged = np.r_[False, single[1:] & single[:-1] & (owner[1:] == owner[:-1])]
    first = first[~merged]
    opens = np.zeros(len(letters), np.int64)
    opens[first] = 1
    ranked = np.cumsum(opens)  # 1 for the letters of the first unit
    framed = np.zeros(len(letters) + 2 * len(first), np.uint8)
    framed[np.arange(len(letters)) + 2 * ranked - 1] = letters
    start = first + 2 * np.arange(len(first))
    return Units(framed, start, np.diff(np.r_[start, len(framed)]), at[first])


def short_runs(units, owner, size):
    """Each ``size`` neighbouring short units of a text as one with GAP between, and the place of its first unit."""
    n = len(units.start) - size + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Units(units.letters[:0], none, none, none), none
    short = units.length <= SHORT + 2
    whole = owner[:n] == owner[size - 1 :]
    for k in range(size):
        whole = whole & short[k : n + k]
    at = np.flatnonzero(whole)
    start = units.start[at]
    spans = units.start[at + size - 1] + units.length[at + size - 1] - start
    piece = np.repeat(np.arange(len(at)), spans)
    step = np.arange(len(piece)) - np.repeat(np.cumsum(spans) - spans, spans)
    letters = units.letters[start[piece] + step]
    inner = (letters == 0) & (step > 0) & (step < spans[piece] - 1)
    # Two edge marks meet between units: the first becomes the gap, the second goes.
    second = inner & np.r_[False, inner[:-1]] if len(inner) else inner
    letters = np.where(inner, GAP, letters)[~second].astype(np.uint8)
    length = spans - (size - 1)
    return Units(letters, np.cumsum(length) - length, length, units.place[at]), at


def _windows(units):
    """Units cut so that none is longer than WINDOW: (start, length, unit) of each piece."""
    index = np.arange(len(units.start))
    if not len(index) or units.length.max() <= WINDOW:
        return units.start, units.length, index
    half = WINDOW // 2
    pieces = np.maximum(1, -(-(units.length - half) // half))
    owner = np.repeat(index, pieces)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = units.start[owner] + step * half
    return start, np.minimum(WINDOW, units.start[owner] + units.length[owner] - start), owner


def length_term(length):
    """Root of the squared weights of a unit of this length, as if no subsequence occurred twice."""
    total = np.zeros(len(length))
    for _, b in PATTERNS:
        total += np.maximum(0, length - b) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, DECAY**6))


def _features(letters, start, length):
    """Yield (piece, feature, weight) arrays, one for each pattern."""
    piece = np.repeat(np.arange(len(start)), length)
    step = np.arange(len(piece)) - np.repeat(np.cumsum(length) - length, length)
    place = start[piece] + step
    left = length[piece] - step
    wide = letters.astype(np.int32)
    for a, b in PATTERNS:
        has = left > b
        i = place[has]
        yield piece[has], (wide[i] << 12) | (wide[i + a] << 6) | wide[i + b], DECAY ** (b + 1)


def unit_scores(units, table):
    """For each unit the largest over its windows of <features, table> / length term."""
    if not len(units.start):
        return np.zeros(0)
    start, length, owner = _windows(units)
    total = np.zeros(len(start))
    for piece, feature, weight in _features(units.letters, start, length):
        total += weight * np.bincount(piece, table[feature], len(start))
    total /= length_term(length)
    if len(start) == len(units.start):
        return total
    best = np.full(len(units.start), -np.inf)
    np.maximum.at(best, owner, total)
    return best


def words_of(texts):
    """The distinct units of each text as bytes of letter classes, edge marks included."""
    out = []
    for lo, hi in blocks(texts):
        array, ends = codes(texts[lo:hi])
        units = units_of(array, ends)
        flat = units.letters.tobytes()
        bags = [set() for _ in range(hi - lo)]
        owner = np.searchsorted(ends, units.place, "right")
        for o, s, n in zip(owner.tolist(), units.start.tolist(), units.length.tolist(), strict=True):
            bags[o].add(flat[s : s + n])
        out += bags
    return out


def _as_units(words):
    length = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(length) - length
    return Units(np.frombuffer(b"".join(words), np.uint8), start, length, start)


def _landmark_tables(words):
    """The subsequences that occur in landmarks, and each landmark's normed weight of each of them."""
    rows = []
    for word in words:
        units = _as_units([word[:WINDOW]])
        found = [(f, np.full(len(f), w)) for _, f, w in _features(units.letters, units.start, units.length)]
        rows.append((*map(np.concatenate, zip(*found, strict=True)), length_term(units.length)[0]))
    slots = np.unique(np.concatenate([feature for feature, _, _ in rows]))
    tables = np.zeros((len(words), len(slots)), np.float32)
    for row, (feature, weight, term) in zip(tables, rows, strict=True):
        np.add.at(row, np.searchsorted(slots, feature), weight / term)
    return slots, tables


def kernel(words, landmarks):
    """Kernel values of each word and each landmark, both as ``words_of`` gives them."""
    slots, tables = _landmark_tables(landmarks)
    n = len(slots)
    place = np.full(CLASSES**3, n, np.int32)
    place[slots] = np.arange(n)
    out = np.full((len(words), len(landmarks)), -np.inf)
    for at in range(0, len(words), KERNEL_ROWS):
        units = _as_units(words[at : at + KERNEL_ROWS])
        start, length, owner = _windows(units)
        x = np.zeros(len(start) * (n + 1))
        for piece, feature, weight in _features(units.letters, start, length):
            x += weight * np.bincount(piece * (n + 1) + place[feature], minlength=len(x))
        x = x.reshape(len(start), n + 1)[:, :n] / length_term(length)[:, None]
        np.maximum.at(out, at + owner, x @ tables.T)
    return out


@dataclass
class Model:
    table: np.ndarray  # score of each subsequence
    bias: float
    slope: float
    offset: float
    floor: float  # raw score of a text without units

    def probability(self, raw):
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -30, 30)))


def raw_scores(texts, model):
    """The highest unit score of each text."""
    out = np.full(len(texts), model.floor)
    for lo, hi in blocks(texts, 1 << 18):
        array, ends = codes(texts[lo:hi])
        units = units_of(array, ends)
        owner = np.searchsorted(ends, units.place, "right")
        best = np.full(hi - lo, model.floor)
        np.maximum.at(best, owner, unit_scores(units, model.table) + model.bias)
        for size in (2, 3):
            runs, at = short_runs(units, owner, size)
            np.maximum.at(best, owner[at], unit_scores(runs, model.table) + model.bias)
        out[lo:hi] = best
    return out


def _lower(column):
    return [(t or "").lower() for t in column.to_pylist()]


def score(docs, model):
    """``docs`` with ``score``, from 0 to 1."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            raw = raw_scores(_lower(batch.column(1)), model)
            yield pa.record_batch([batch.column(0), pa.array(model.probability(raw))], names=["doc_id", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def reject(docs, model, threshold=0.3):
    """``docs`` without the rows that score ``threshold`` or more; columns and rows are otherwise unchanged."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            p = model.probability(raw_scores(_lower(batch.column(at)), model))
            yield batch.filter(pa.array(p < threshold))

    return map_arrow(docs, run, docs.schema)


def training_sentences(docs, labels, max_docs, max_sentences):
    """Sentences of a bounded sample of labelled documents: doc_id, toxic, words."""
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    by_hash = F.xxhash64("doc_id")
    sample = marks.filter("toxic = 1").orderBy(by_hash, "doc_id").limit(max_docs).unionByName(
        marks.filter("toxic <> 1").orderBy(by_hash, "doc_id").limit(max_docs)
    )
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(sample), "doc_id"
    )
    sentences = texts.select(
        "doc_id", "toxic", F.posexplode(F.split(F.lower("text"), r"[.!?\n]+\s*")).alias("place", "sentence")
    ).filter(F.length("sentence") > 0)
    share = sentences.orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place").limit(max_sentences)
    return sample, texts, share


def _svm(x, y, weight, cost, steps=30):
    """Linear support vector machine with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        xs, ws = x[on], weight[on]
        gradient = ridge @ w - 2 * cost * xs.T @ (ws * y[on] * slack[on])
        step = np.linalg.solve(ridge + 2 * cost * (xs * ws[:, None]).T @ xs, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], w[-1]


def _platt(raw, y, steps=50):
    """Slope and offset of a logistic curve through labelled raw scores, smoothed targets."""
    positive, negative = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.c_[raw, np.ones(len(raw))]
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target))
        w -= np.clip(step, -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs, labels, max_docs=3000, max_sentences=80_000, n_landmarks=192, cost=4.0, rounds=3):
    """Train on the labelled documents given; see the module for the bounds."""
    sample, texts, sentences = training_sentences(docs, labels, max_docs, max_sentences)
    rows = sentences.select("toxic", "sentence").toArrow()
    toxic = np.array(rows.column(0).to_pylist(), bool)
    if not toxic.any() or toxic.all():
        share = float(toxic.mean()) if len(toxic) else 0.0
        edge = min(max(share, 1e-12), 1 - 1e-12)
        return Model(np.zeros(CLASSES**3, np.float32), 0.0, 1e-3, float(np.log(edge / (1 - edge))), 0.0)
    bags = [sorted(w for w in bag if len(w) > 4) for bag in words_of(rows.column(1).to_pylist())]
    words = sorted({w for bag in bags for w in bag})
    index = {w: i for i, w in enumerate(words)}
    count = np.zeros((2, len(words)))
    for mark, bag in zip(toxic, bags, strict=True):
        for w in bag:
            count[int(mark), index[w]] += 1
    # Witness of a toxic sentence: the word whose counts speak most for the toxic class.
    rate = (count[1] + 0.5) / (toxic.sum() + 1)
    base = (count[0] + 0.5) / ((~toxic).sum() + 1)
    lift = np.log(rate / base)
    strength = count[1] * np.maximum(lift, 0)
    expected = count[0] * toxic.sum() / (~toxic).sum()
    excess = (count[1] - expected) / np.sqrt(count[1] + expected + 1)
    telling = (lift > 1) & (excess >= max(1.4, min(4.0, excess.max() / 2)))
    value = np.where(telling, strength, -1.0)
    toxic_bags = [np.array([index[w] for w in bag]) for mark, bag in zip(toxic, bags, strict=True) if mark and bag]
    clean_words = np.flatnonzero(count[0] > 0)
    clean_words = clean_words[np.argsort(-count[0][clean_words], kind="stable")]
    leading = [words[i] for i in np.argsort(-value, kind="stable")[: n_landmarks // 2] if value[i] > 0]
    landmarks = leading + [words[i] for i in clean_words[: n_landmarks // 4]]
    all_units = _as_units(words)
    negatives = set(clean_words[:4000].tolist())
    for _ in range(rounds):
        gram = kernel(landmarks, landmarks)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        witness = np.array([bag[np.argmax(value[bag])] for bag in toxic_bags], np.int64)
        witness = witness[value[witness] > 0]
        if not len(witness):
            witness = np.argsort(-strength, kind="stable")[:1]
        positive, times = np.unique(witness, return_counts=True)
        negative = np.array(sorted(negatives - set(positive.tolist())), np.int64)
        broken, origin = _broken([words[i] for i in positive])
        rows_of = [words[i] for i in positive] + broken + [words[i] for i in negative]
        x = kernel(rows_of, landmarks) @ root
        n = len(positive) + len(broken)
        y = np.r_[np.ones(n), -np.ones(len(negative))]
        weight = np.r_[times, times[origin] * BROKEN_WEIGHT, np.sqrt(count[0][negative])]
        weight[:n] /= weight[:n].sum()
        weight[n:] /= weight[n:].sum() + 1e-12
        w, bias = _svm(x, y, weight * len(y), cost)
        slots, tables = _landmark_tables(landmarks)
        table = np.zeros(CLASSES**3, np.float32)
        table[slots] = (root @ w) @ tables
        found = unit_scores(all_units, table) + bias
        value = np.where(telling, strength * np.exp(np.minimum(found, 2.0)), -1.0)
        hard = clean_words[np.argsort(-found[clean_words], kind="stable")[:2000]]
        negatives |= set(hard.tolist())
        landmarks += [words[i] for i in hard[: n_landmarks // 4 // rounds] if words[i] not in landmarks]
    model = Model(table, float(bias), 1.0, 0.0, float(bias) - 1.0)
    held = map_arrow(texts.select("doc_id", "toxic", "text"), _raw_rows(model), "toxic int, raw double").toArrow()
    raw, y = np.array(held.column(1)), np.array(held.column(0))
    slope, offset = _platt(raw, (y == 1).astype(float))
    return Model(table, float(bias), slope, offset, float(min(bias - 1.0, raw.min())))


def _raw_rows(model):
    def run(batches):
        for batch in batches:
            raw = raw_scores(_lower(batch.column(2)), model)
            yield pa.record_batch([batch.column(1).cast(pa.int32()), pa.array(raw)], names=["toxic", "raw"])

    return run


def _broken(words):
    """Words with one letter put in, as evasions write them, and the place of each word's origin."""
    out, origin = [], []
    for i, word in enumerate(words):
        for at in range(3, len(word) - 2, 2) if len(word) >= MIN_BROKEN else ():
            for letter in (24, 21 + at % 3):  # x, or one of u, v, w
                out.append(word[:at] + bytes([letter]) + word[at:])
                origin.append(i)
    return out, np.array(origin, np.int64)


def trainable(labels, fold=2, folds=4):
    """Labels outside the held-out fold of crc32(doc_id as text)."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != fold)


def classify(docs, model, threshold=0.3):
    """One row per document: doc_id, score, predicted."""
    return score(docs, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
