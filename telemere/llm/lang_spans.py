"""Language of whole texts by a Viterbi path over per-word scores.

Each word is scored for each learned language by the log probabilities of its letter
sequences of one to three letters, edges included. The scripts of a word's letters, by
Unicode ranges, narrow the candidates: languages never seen in its script are ruled out,
unless that rules out all. A Viterbi path over the words of a text, with a penalty for each switch of
language, labels spans. The text's language is the one whose spans hold the most letters;
its score is those letters' share of the text's, times the mean certainty of their
words' scores over the path.

The model is learnt from at most ``max_docs`` documents a language, chosen by hash.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows with a
null or empty language teach nothing; with no language at all every text is ``und``; ties
between languages go to the first in order of name. Extra columns may have any name.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemere.llm.tables import map_arrow
from telemere.llm.textblocks import blocks, codes

UNDETERMINED = "und"
#: Log probability that a switch between two words costs.
SWITCH = 12.0
#: Slots of the hashed tables of letter sequences, and the smoothing count of a sequence.
SLOTS = 1 << 18
SMOOTH = 0.5
#: The most that one word can speak for a language over another.
WORD_LIMIT = 25.0

# Scripts by their main ranges of code points (fixed values of the Unicode standard), each first and last.
SCRIPTS = [
    ("latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)]),
]
OTHER = len(SCRIPTS)


@functools.cache
def _tables():
    """Code point below 65536 -> script number of a letter, or -1."""
    script = np.full(1 << 16, -1, np.int8)
    script[[c for c in range(1 << 16) if chr(c).isalpha()]] = OTHER
    for number, (_, ranges) in enumerate(SCRIPTS):
        for first, last in ranges:
            part = script[first : last + 1]
            part[part >= 0] = number
    return script


@dataclass
class Words:
    letters: np.ndarray  # letters of all words, one after the other, as code points
    script: np.ndarray  # script of each letter
    start: np.ndarray
    length: np.ndarray
    place: np.ndarray  # where each word begins in the code array


def words_of(array):
    """Runs of letters of a code array."""
    table = _tables()
    script = table[np.minimum(array, 0xFFFF)]
    above = np.flatnonzero(array > 0xFFFF)
    if len(above):  # judged once for each distinct code point
        points, which = np.unique(array[above], return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in points.tolist()])
        script[above] = np.where(letter, OTHER, -1)[which]
    at = np.flatnonzero(script >= 0)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    return Words(array[at], script[at], first, np.diff(np.r_[first, len(at)]), at[first])


def _sequences(words):
    """Slots of the sequences of one, two and three letters that end at each place of the framed words.

    A frame is a word between two edges, 0. Also returns where each word's places begin and
    end: from its first letter to its closing edge. Single edges have the slot SLOTS.
    """
    n = len(words.start)
    index = np.arange(n)
    framed = np.zeros(len(words.letters) + 2 * n, np.uint64)
    begin = words.start + 2 * index + 1
    framed[np.arange(len(words.letters)) + 2 * np.repeat(index, words.length) + 1] = words.letters
    one = _slot(framed, 1)
    one[framed == 0] = SLOTS
    keys = framed.copy()
    keys[1:] += framed[:-1] * np.uint64(0x110000)
    two = _slot(keys, 2)
    keys[2:] += framed[:-2] * np.uint64(0x12100000001)
    three = _slot(keys, 3)
    return (one, two, three), begin, begin + words.length + 1


def _slot(keys, salt):
    h = (keys + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(46)).astype(np.int32)


@dataclass
class Model:
    languages: list
    tables: list  # for one, two and three letters: log probabilities [slot, language], 0 in the last slot
    seen: np.ndarray  # [script, language]: whether the language's training texts use the script


def word_scores(words, model):
    """Log probabilities [word, language], with languages that a word's script rules out far below the rest."""
    slots, begin, end = _sequences(words)
    total = model.tables[0][slots[0]]
    total += model.tables[1][slots[1]]
    total += model.tables[2][slots[2]]
    sums = np.cumsum(total, axis=0, dtype=np.float64)
    out = (sums[end - 1] - sums[begin - 1]).astype(np.float32)
    out -= out.max(axis=1, keepdims=True)
    np.maximum(out, -WORD_LIMIT, out=out)
    if not model.seen.all():
        possible = np.ones_like(out, bool)
        occur = np.bincount(words.script, minlength=OTHER + 1) > 0
        for number in np.flatnonzero(occur & ~model.seen.all(axis=1)).tolist():
            has = np.add.reduceat(words.script == number, words.start) > 0
            possible[has] &= model.seen[number]
        possible[~possible.any(axis=1)] = True
        out = np.where(possible, out, -4 * WORD_LIMIT)
    return out


def viterbi(scores, starts, lengths, penalty=SWITCH):
    """The best language of each word, for many texts side by side: text i has words starts[i] .. + lengths[i]."""
    total, n_lang = scores.shape
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    came = np.zeros((total, n_lang), np.int16 if n_lang <= 1 << 15 else np.int32)
    best = np.zeros((len(starts), n_lang), np.float64)
    live = np.searchsorted(-lengths, 0, "left")  # texts with a word
    step = 0
    while live:
        at = starts[:live] + step
        if step:
            top = best[:live].argmax(axis=1)
            jump = best[np.arange(live), top] - penalty
            stay = best[:live] >= jump[:, None]
            came[at] = np.where(stay, np.arange(n_lang), top[:, None])
            best[:live] = np.where(stay, best[:live], jump[:, None])
        best[:live] += scores[at]
        best[:live] -= best[:live].max(axis=1, keepdims=True)
        step += 1
        live = int(np.searchsorted(-lengths, -step, "left")) if step else live
    label = np.zeros(total, came.dtype)
    state = best.argmax(axis=1).astype(came.dtype)
    for step in range(int(lengths[0]) - 1 if len(lengths) else -1, -1, -1):
        live = int(np.searchsorted(-lengths, -step, "left"))
        at = starts[:live] + step
        label[at] = state[:live]
        state[:live] = came[at, state[:live]]
    return label


def _block(texts, model, penalty):
    """For a run of texts: the words, the text of each, its label, and per text letters by language and certainty."""
    array, ends = codes(texts)
    words = words_of(array)
    n = len(texts)
    owner = np.searchsorted(ends, words.place, "right")
    scores = word_scores(words, model) if len(words.start) else np.zeros((0, len(model.languages)), np.float32)
    lengths = np.bincount(owner, minlength=n)
    label = viterbi(scores, np.cumsum(lengths) - lengths, lengths, penalty)
    return array, ends, words, owner, scores, label


def label_texts(texts, model, penalty=SWITCH):
    """Language and score of each text."""
    languages = np.array([*model.languages, UNDETERMINED], object)
    names, values = [], []
    k = len(model.languages)
    for lo, hi in blocks(texts, 1 << 22):
        n = hi - lo
        _, _, words, owner, scores, label = _block(texts[lo:hi], model, penalty)
        letters = np.bincount(owner * k + label, words.length, n * k).reshape(n, k)
        total = letters.sum(axis=1)
        top = letters.argmax(axis=1)
        # Certainty of a word: its language's share of the probabilities that its letters give.
        share = np.exp(scores[np.arange(len(label)), label]) / np.exp(scores).sum(axis=1) if len(label) else np.zeros(0)
        mine = label == top[owner]
        sure = np.bincount(owner[mine], (share * words.length)[mine], n)
        names += languages[np.where(total > 0, top, k)].tolist()
        values += (np.where(total > 0, sure / np.maximum(total, 1), 0.0)).clip(0, 1).tolist()
    return names, values


def text_spans(text, model, penalty=SWITCH):
    """Spans of one text: (start, end, language), by characters, from the first word of a span to its last."""
    if not text or not model.languages:
        return []
    _, _, words, _, _, label = _block([text], model, penalty)
    if not len(label):
        return []
    first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
    last = np.r_[first[1:], len(label)] - 1
    end = words.place[last] + words.length[last]
    return [
        (int(words.place[a]), int(e), model.languages[label[a]]) for a, e in zip(first, end, strict=True)
    ]


def _texts(column):
    return [t or "" for t in column.to_pylist()]


def identify(docs, model, penalty=SWITCH):
    """One row per document: doc_id, lang_pred, score."""

    def run(batches):
        for batch in batches:
            if model.languages:
                names, values = label_texts([t.lower() for t in _texts(batch.column(1))], model, penalty)
            else:
                names, values = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows
            yield pa.record_batch(
                [batch.column(0), pa.array(names, pa.string()), pa.array(values, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double")


def spans(docs, model, penalty=SWITCH):
    """One row per document: doc_id and its spans (start, end, language)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            found = [
                [dict(zip(("start", "end", "lang"), s, strict=True)) for s in text_spans(t, model, penalty)]
                for t in _texts(batch.column(1))
            ]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(rows, run, "doc_id long, spans array<struct<start: long, end: long, lang: string>>")


def _counts(batches):
    """Counts of letter sequences and scripts of each language of the task's rows, as sparse rows."""
    sums = {}
    for batch in batches:
        texts, langs = _texts(batch.column(0)), batch.column(1).to_pylist()
        for lang in set(langs):
            own = [t.lower() for t, other in zip(texts, langs, strict=True) if other == lang]
            if lang not in sums:
                sums[lang] = [*(np.zeros(SLOTS, np.int64) for _ in range(3)), np.zeros(OTHER + 1, np.int64)]
            for lo, hi in blocks(own):
                words = words_of(codes(own[lo:hi])[0])
                if len(words.start):
                    slots, begin, end = _sequences(words)
                    inner = np.zeros(len(slots[0]) + 1, np.int8)
                    inner[begin] += 1
                    inner[end] -= 1
                    inner = np.cumsum(inner[:-1]) > 0
                    for count, slot in zip(sums[lang], slots, strict=False):
                        count += np.bincount(slot[inner], minlength=SLOTS + 1)[:SLOTS]
                    sums[lang][3] += np.bincount(words.script, minlength=OTHER + 1)
    for lang, parts in sums.items():
        for size, counts in enumerate(parts):
            at = np.flatnonzero(counts)
            yield pa.record_batch(
                [
                    pa.array([lang] * len(at), pa.string()),
                    pa.array(np.full(len(at), size), pa.int32()),
                    pa.array(at, pa.int32()),
                    pa.array(counts[at], pa.int64()),
                ],
                names=["lang", "size", "slot", "n"],
            )


def fit(docs, max_docs=1500):
    """Learn from ``text`` and ``lang`` of at most ``max_docs`` documents a language."""
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    ids = (
        docs.filter("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL")
        .select("doc_id", "lang")
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= max_docs)
        .select("doc_id")
        .distinct()
    )
    sample = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").filter("lang <> ''")
    counts = map_arrow(sample.select("text", "lang"), _counts, "lang string, size int, slot int, n long")
    rows = counts.groupBy("lang", "size", "slot").agg(F.sum("n").alias("n")).toArrow()
    lang, size, slot, n = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    languages = sorted(set(lang.tolist()))
    index = np.array([languages.index(x) for x in lang.tolist()], np.int64) if languages else np.zeros(0, np.int64)
    tables = []
    for k in range(3):
        table = np.zeros((SLOTS, len(languages)))
        table[slot[size == k], index[size == k]] = n[size == k]
        used = max(1, int((table.sum(axis=1) > 0).sum())) if len(languages) else 1
        table = np.log((table + SMOOTH) / (table.sum(axis=0) + SMOOTH * used))
        tables.append(np.concatenate([table, np.zeros((1, len(languages)))]).astype(np.float32))
    seen = np.zeros((OTHER + 1, len(languages)))
    seen[slot[size == 3], index[size == 3]] = n[size == 3]
    # A script counts as a language's own from one letter in a thousand; stray foreign words do not make it so.
    seen = seen > seen.sum(axis=0) / 1000
    return Model(languages, tables, seen)


def trainable(docs, fold=1, folds=3):
    """Documents outside the held-out fold of crc32(doc_id as text)."""
    return docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != fold)
