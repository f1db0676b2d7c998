"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents fall into cells of (source, language, topic). Each cell's tokens are raked
until their sums by source, by language and by topic equal the targets; the cell's
rate is its fitted tokens over its tokens. A document stays when a number drawn from
its id and text is below its cell's rate, at most 1, so the kept tokens meet the
targets in expectation and the same table always gives the same sample.

Cells are a table: there are as many as combinations that occur. More than ``CELLS_SENT`` are
fitted by partial sums and joins, so neither the driver nor one task holds them all; fewer
are fitted by the same rounds in the driver.

Fitting ends when each target that its label's tokens can fill is met to a relative
``tolerance``. Targets can be at odds once a cell gives all it has; then the rates settle
without meeting them, and a ``RuntimeWarning`` gives the largest error that is left.

Defined cases: null and empty source or language are the label ``unknown``; a null or
empty text has 0 tokens and takes the rate of its cell, and cells without any token
have rate 1, as nothing can be weighed; repeated rows draw the same number and stay or
go together; an empty table gives an empty result; extra columns may have any name.
"""

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from telemere.llm.tables import fresh, join_groups, kept

#: Marks of documents' topics in order of precedence (fixed patterns of this library); the rest is ``prose``. Runs are
#: taken whole and never given back, so a text takes time in proportion to its length, however long its lines are.
TOPICS = [
    ("legal", r"(?i)licen[sc]ed? under|all rights reserved|released under"),
    ("contact", r"[\w.]@[\w.-]+\.\w|\+\d[\d ()-]{7}"),
    ("table", r"\|[^|\n]*+\|[^|\n]*+\|"),
    ("noise", r"[*%$&#!]{2}\s(?:\S*+(?<=[*%$&#!]{2})\s){2}"),
]
MARGINS = ("source", "lang", "topic")
#: The power that flattens each margin's tokens to its targets, and the part of all tokens that stays.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
SHARE = 0.4
#: Up to so many cells are fitted in the driver and broadcast; of more, those with more than one document in so many
#: are broadcast and the others join by shuffle.
CELLS_SENT = 100_000
UNKNOWN = "unknown"
DRAWS = 1 << 52


def topic(text):
    """The topic of a text: the first whose mark occurs in it."""
    found = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def n_tokens(text):
    """Words of a text: runs of other than ASCII white space."""
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " "))
    return F.when(words == "", 0).otherwise(F.length(words) - F.length(F.translate(words, " ", "")) + 1).cast("long")


def draw(doc_id, text):
    """A number from 0 to 1 fixed by a document's id and text."""
    mixed = F.xxhash64(doc_id.cast("string"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    return F.pmod(mixed, F.lit(DRAWS)) / F.lit(float(DRAWS))


def label(column):
    return F.when(F.coalesce(column, F.lit("")) == "", UNKNOWN).otherwise(column)


def labels(docs):
    """The columns of a document's cell: the name of each margin's column -> its expression."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return {"source": label(F.col("source")), "lang": label(F.col("lang")), "topic": topic(text)}


def cells_of(docs):
    """Tokens and documents of each cell that occurs."""
    named = docs.select(*[e.alias(m) for m, e in labels(docs).items()], n_tokens(F.col("text")).alias("n_tokens"))
    return named.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))


def targets(cells, margin, power, budget):
    """Target tokens of each label of a margin: ``budget`` shared by tokens ** power; and whether its tokens fill it."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("now"))
    whole = sums.agg(F.sum(F.pow("now", F.lit(power)))).first()[0] or 1.0
    return sums.select(margin, "now", (F.pow("now", F.lit(power)) * (budget / whole)).alias("target")).select(
        margin, "target", (F.col("target") <= F.col("now")).alias("feasible")
    )


def fit(cells, powers=POWERS, share=SHARE, rounds=200, tolerance=1e-3, sent=CELLS_SENT):
    """Cells with their ``rate``, the part of their tokens to keep, from 0 to 1.

    ``powers``: for each margin the power that flattens it (1 keeps it, 0 evens it out).
    ``share``: the part of all tokens to keep. A cell cannot give more tokens than it
    has, so a round ends by cutting it there. Stops when a round finds every feasible
    target met to a relative ``tolerance``. Rates that settle before that, or not within
    ``rounds``, are reported by a warning.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("rate", F.lit(1.0))
    if cells.limit(sent + 1).count() <= sent:
        rated, off = _fit_few(cells, powers, share, rounds, tolerance)
    else:
        rated, off = _fit_many(cells, total, powers, share, rounds, tolerance)
    if off > tolerance:
        warnings.warn(f"raking leaves a target off by {off:.3g} of it", RuntimeWarning, stacklevel=2)
    return rated


def _settled(off, step, tolerance):
    """Whether a round was the last: all feasible targets met, or no rate moves any more."""
    return off <= tolerance or step <= tolerance / 1000


def _fit_few(cells, powers, share, rounds, tolerance):
    """Rated cells and the largest relative error of a feasible target, by arrays in the driver."""
    table = cells.select(*MARGINS, "tokens", "docs").toArrow()
    tokens = table["tokens"].to_numpy().astype(float)
    rate = np.full(len(tokens), float(share))
    margins = []
    for m in MARGINS:
        place = np.unique(np.array(table[m].to_pylist(), object), return_inverse=True)[1]
        now = np.bincount(place, tokens)
        flat = np.where(now > 0, now ** powers[m], 0.0 if powers[m] else 1.0)
        target = flat * (tokens.sum() * share / flat.sum())
        margins.append((place, target, (target <= now) & (target > 0)))
    for _ in range(rounds):
        was, off = rate, 0.0
        for place, target, feasible in margins:
            sums = np.bincount(place, rate * tokens)
            factor = np.where(sums > 0, target / np.where(sums > 0, sums, 1.0), 1.0)
            off = max(off, float(np.abs(1 / factor[feasible] - 1).max(initial=0.0)))
            rate = rate * factor[place]
        rate = np.minimum(rate, 1.0)
        if _settled(off, float(np.abs(rate - was).max()), tolerance):
            break
    rated = table.append_column("rate", pa.array(rate, pa.float64()))
    return cells.sparkSession.createDataFrame(rated), off


def _fit_many(cells, total, powers, share, rounds, tolerance):
    """The same by tables. Each round's table ends the lineage."""
    fitted = cells.select(*MARGINS, "tokens", "docs").withColumn("rate", F.lit(float(share)))
    wanted = {m: kept(targets(cells, m, powers[m], total * share), "targets") for m in MARGINS}
    for _ in range(rounds):
        moved = fitted.withColumn("was", F.col("rate")).withColumn("off", F.lit(0.0))
        for margin in MARGINS:
            sums = moved.groupBy(margin).agg(F.sum(F.col("rate") * F.col("tokens")).alias("sum"))
            factor = sums.join(wanted[margin], margin).select(
                margin,
                F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).otherwise(1.0).alias("factor"),
                F.when(F.col("feasible") & (F.col("target") > 0), F.abs(F.col("sum") / F.col("target") - 1))
                .otherwise(0.0)
                .alias("error"),
            )
            moved = (
                moved.join(factor, margin)
                .withColumn("rate", F.col("rate") * F.col("factor"))
                .withColumn("off", F.greatest("off", "error"))
                .drop("factor", "error")
            )
        moved = kept(moved.withColumn("rate", F.least("rate", F.lit(1.0))), "cells")
        off, step = moved.agg(F.max("off"), F.max(F.abs(F.col("rate") - F.col("was")))).first()
        fitted = moved.select(*MARGINS, "tokens", "docs", "rate")
        if _settled(off, step, tolerance):
            break
    return fitted, off


def _rated(named, cells, key, rate, powers, share):
    """``named``, whose column ``key`` is the struct of a row's labels, with the ``rate`` of its cell."""
    cells = kept(cells, "cells")
    total = cells.agg(F.sum("docs")).first()[0] or 0
    rated = fit(cells, powers, share)
    size = fresh("docs")
    groups = rated.select(F.struct(*MARGINS).alias(key), F.col("docs").alias(size), F.col("rate").alias(rate))
    if rated.limit(CELLS_SENT + 1).count() <= CELLS_SENT:
        joined = named.join(F.broadcast(groups), key, "left")
    else:
        joined = join_groups(named, groups, key, size, total, CELLS_SENT)
    return joined.drop(size)


def mix(docs, powers=POWERS, share=SHARE):
    """One row per document: doc_id, source, lang, topic, n_tokens, rate, kept.

    Texts are read once: labels, tokens and draws go to a narrow table, which is counted and answered from.
    """
    text = F.col("text")
    named = kept(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.struct(*[e.alias(m) for m, e in labels(docs).items()]).alias("cell"),
            n_tokens(text).alias("n_tokens"),
            draw(F.col("doc_id"), text).alias("draw"),
        ),
        "marked",
    )
    cells = named.groupBy(*[F.col(f"cell.{m}").alias(m) for m in MARGINS]).agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )
    return _rated(named, cells, "cell", "rate", powers, share).select(
        "doc_id", "cell.*", "n_tokens", F.round("rate", 6).alias("rate"), (F.col("draw") < F.col("rate")).alias("kept")
    )


def sample(docs, powers=POWERS, share=SHARE):
    """The rows that stay, all their columns unchanged. Texts are labelled twice: a narrow table could only be joined by a shuffle of them."""
    key, rate = fresh("cell"), fresh("rate")
    named = docs.withColumn(key, F.struct(*[e.alias(m) for m, e in labels(docs).items()]))
    out = _rated(named, cells_of(docs), key, rate, powers, share)
    stays = draw(F.col("doc_id"), F.col("text")) < F.col(rate)
    return out.filter(stays).select(*[F.col(f"`{c}`") for c in docs.columns])
