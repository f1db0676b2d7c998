"""Small tables with every awkward case, and plain Python versions of the contracts."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, suspect int, node string"


def words(rng, n, lang="en"):
    parts = {"en": ["the", "thing", "of", "reason", "and", "bright"], "de": ["der", "schung", "und", "keitung", "nicht"]}
    return " ".join(rng.choice(parts[lang]) + rng.choice(["", "a", "er", "on", "ti"]) for _ in range(n))


def documents(spark, extra=()):
    """Plain, near and exact copies, null, empty and very long texts, repeated rows, null columns, clashing names."""
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(6)]
    rows = []
    for i, text in enumerate(base):
        rows.append((i, text, "en", "src0"))
        near = text.split()
        near[60] = "changed"
        rows.append((100 + i, " ".join(near), "en", "src1"))
        rows.append((200 + i, text, "en", "src0"))
    rows += [(300, None, None, None), (301, "", "en", ""), (302, " \n\t", "de", "src2"), (303, "one two", "en", "src2")]
    rows += [(304, "one two", None, "src2"), (305, words(rng, 30_000, "de"), "de", "src3"), (None, base[0], "en", "src0")]
    rows += [(306, "x" * 200_000, "en", "src3"), (307, words(rng, 40, "de"), "de", "src2")]
    rows += [(307, rows[-1][1], "de", "src2"), (308, "漢字 かな 🙂 \x00", "en", "src2")]
    rows += list(extra)
    full = [(i, t, lang, source, None if t is None else len(t), "x", 1, "y") for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain(df):
    return [tuple(r) for r in df.collect()]


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}
