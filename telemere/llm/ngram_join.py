"""N-gram Jaccard self-join by token-combination prefixes.

A document is the set of its distinct five-word shingles; two documents link when the
Jaccard similarity of their sets reaches ``PERCENT`` per cent. Shingles are tokens of
one global order: rare ones first, then frequent ones, each by hash. Which are frequent
is read from counts of all documents' shingles in a table of fixed size.

A document gives as signatures the tokens of a prefix in that order: rare tokens alone,
frequent ones as pairs within classes of frequent tokens. Pairs are taken within a class
because two documents that share at least two tokens of one class share such a pair. The
prefix is extended until sum(rare tokens) + sum over classes (tokens - 1) exceeds the
number of tokens that a linked partner may lack. So of two linked documents, the one
whose prefix ends first in the order shares with the other a rare token of it, or two
tokens of one class: no link is missed. The number of classes follows from a
document's size, rounded to a power of two, and documents give the pairs of each
rounding that a partner may have; so pairs stay in proportion to tokens.

Documents with equal sets are one node. A rare token's list of nodes is bounded by its counter's
limit, so its pairs are made and counted, and pairs that share fewer signatures than a link
needs are left out. A list of a token pair has no bound: its nodes are verified against the
list's smallest one, and lists with the same smallest node make one crowd. A crowd whose members
are all in one component by then is settled. The members of the others are compared across
components, in blocks of bounded size that count common tokens and give the links alone. So a group of near copies gives rows in
proportion to its size, and every pair that could still join two components is compared.

Defined cases: a null or empty text, or one without words, has no shingle and links with
nothing; with fewer than five words the whole sequence is the one shingle. Rows that share
a doc_id are one node. A null doc_id takes part in no link and has no component. Columns
other than ``doc_id`` and ``text`` may have any name. An empty table gives an empty result.
Hashes have 64 bits, so different shingles of two documents are taken as equal with a
chance below one in 10 ** 9 even for sets of 100,000 shingles.
"""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from telemere.llm import bloom
from telemere.llm.components import connected
from telemere.llm.shingles import distinct, mix, shingle_sets
from telemere.llm.tables import drop_ids, join_groups, kept, map_arrow

PERCENT = 80
#: Counters for a document in the table that tells frequent tokens, its least and its largest size (64 MB
#: a task, 8 MB of bits for all), and how many counters a row of it has.
COUNTERS_A_DOCUMENT = 64
LEAST_COUNTERS, MOST_COUNTERS = 1 << 20, 1 << 26
CHUNK = 1 << 14
#: Tokens that a task counts in one go.
COUNTED_AT_ONCE = 300_000
#: Frequent tokens of a prefix that fall into one class, about.
CLASS_TOKENS = 4
#: Tokens of a share of a crowd, about: two shares are in memory at once.
SHARE_TOKENS = 400_000
#: Smaller sets link only with equal ones.
LEAST = 4

_ODD = np.uint64(1)
_A, _B, _C = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def counters_for(documents):
    """The size of the table of counters: a power of two within its bounds."""
    size = LEAST_COUNTERS
    while size < min(documents * COUNTERS_A_DOCUMENT, MOST_COUNTERS):
        size *= 2
    return size


def _counter(tokens, counters):
    return (tokens >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def _scan(counters):
    """A row for each document (doc_id, n, set_id) and, at the end, rows of the counters that are not zero.

    A task's counters stop at 255.
    """
    names = ["doc_id", "n", "set_id", "chunk", "counts"]

    def run(batches):
        counts = np.zeros(counters, np.uint8)

        def count(sets):
            at, times = np.unique(_counter(np.concatenate(list(sets.values())), counters), return_counts=True)
            counts[at] = np.minimum(counts[at] + times, 255)

        for batch in batches:
            ids, sizes, once, waiting = [], [], {}, 0
            for tokens in shingle_sets(batch.column(1)):
                ids.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                sizes.append(len(tokens))
                once[ids[-1]] = tokens
                waiting += len(tokens)
                if waiting > COUNTED_AT_ONCE:
                    count(once)
                    once, waiting = {}, 0
            if once:
                count(once)
            n = len(ids)
            sizes = pa.array(sizes, pa.int64())
            nothing = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.record_batch(
                [batch.column(0).cast(pa.int64()), sizes, pa.array(ids, pa.binary()), *nothing], names=names
            )
        parts = counts.reshape(-1, CHUNK)
        full = np.flatnonzero(parts.any(axis=1))
        nothing = [pa.nulls(len(full), kind) for kind in (pa.int64(), pa.int64(), pa.binary())]
        packed = pa.array([zlib.compress(parts[i].tobytes(), 1) for i in full], pa.binary())
        yield pa.record_batch([*nothing, pa.array(full, pa.int32()), packed], names=names)

    return run


def _heavy(limit):
    """Sum the counters of each chunk and keep, as bits, which exceed ``limit``."""

    def run(batches):
        sums = {}
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(packed), np.uint8)
                if chunk in sums:
                    sums[chunk] += counts
                else:
                    sums[chunk] = counts.astype(np.int64)
        bits = [np.packbits(s > limit).tobytes() for s in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["chunk", "bits"])

    return run


def frequent_counters(scan, tokens, counters):
    """For each counter whether its tokens are frequent: well above what hashing alone gives a counter."""
    mean = tokens / counters
    limit = min(mean + 6 * mean**0.5 + 6, 254)
    rows = map_arrow(
        scan.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk"),
        _heavy(limit),
        "chunk int, bits binary",
    )
    heavy = np.zeros(counters, bool)
    for chunk, bits in rows.toLocalIterator():
        heavy[chunk * CHUNK : (chunk + 1) * CHUNK] = np.unpackbits(np.frombuffer(bits, np.uint8))
    return heavy


def lacking(n):
    """How many of its tokens a linked partner of a set of n tokens may lack."""
    return n - -(-PERCENT * n // 100)


def signatures(tokens, heavy):
    """The signatures of a sorted distinct token array, and whether all are single tokens.

    Those of single tokens are even, those of token pairs odd.
    """
    n = len(tokens)
    if n < LEAST:
        return tokens[:0], True
    need = lacking(n) + 1
    frequent = heavy[_counter(tokens, len(heavy))]
    rare = tokens[~frequent]
    if len(rare) >= need:
        return distinct(rare[:need] & ~_ODD), True
    tokens, need = tokens[frequent], need - len(rare)
    spread = mix(tokens ^ _C)
    out = [rare & ~_ODD]
    smallest, largest = -(-PERCENT * n // 100), 100 * n // PERCENT
    for size in range(smallest.bit_length(), largest.bit_length() + 1):
        classes = max(1, (1 << size) // (10 * CLASS_TOKENS))
        label = (spread % np.uint64(classes)).astype(np.int64)
        fresh = np.zeros(len(tokens), bool)
        fresh[np.unique(label, return_index=True)[1]] = True
        end = int(np.searchsorted(np.cumsum(~fresh), need)) + 1
        order = np.argsort(label[:end], kind="stable")
        group, token = label[:end][order], tokens[:end][order]
        # Pairs of a token with each later one of its class.
        step = 1
        while step < end:
            same = group[step:] == group[:-step]
            if not same.any():
                break
            left, right = token[:-step][same], token[step:][same]
            out.append(mix(left * _A + right * _B + np.uint64(size)) | _ODD)
            step += 1
    return distinct(np.concatenate(out)), False


def _signature_rows(shared):
    def run(batches):
        heavy = shared.value
        for batch in batches:
            sizes, single, lists = [], [], []
            for tokens in shingle_sets(batch.column(1)):
                found, alone = signatures(tokens, heavy)
                sizes.append(len(tokens))
                single.append(alone)
                lists.append(found.view(np.int64))
            offsets = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
            values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            packed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(single, pa.bool_()), packed],
                names=["doc_id", "n", "single", "signatures"],
            )

    return run


def linked(a, b):
    """Whether two sorted distinct token arrays link."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    same = int((large[at] == small).sum())
    return 100 * same >= PERCENT * (len(a) + len(b) - same)


def _verify(batches):
    """Rows (a, b, text_a, text_b), sorted by a within a task -> the linked (a, b)."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts = [i for i in range(len(a)) if i == 0 or a[i] != a[i - 1]]
        ones = list(shingle_sets(batch.column(2).take(pa.array(starts, pa.int64()))))
        row, keep = -1, []
        for i, other in enumerate(shingle_sets(batch.column(3))):
            if row + 1 < len(starts) and starts[row + 1] == i:
                row += 1
            if linked(ones[row], other):
                keep.append(i)
        pairs = [pa.array([side[i] for i in keep], pa.int64()) for side in (a, b)]
        yield pa.record_batch(pairs, names=["a", "b"])


def _texts_of(ids, docs):
    """doc_id and text of the documents that a Bloom filter of the distinct ``ids`` lets pass."""
    ids = kept(ids, "candidates")
    bits = bloom.filter_bits(ids.count())
    probed = bloom.probe(
        docs.filter("doc_id IS NOT NULL"), bloom.members(ids, "doc_id", bits), F.col("doc_id"), bits, "candidate"
    )
    return probed.filter("candidate").select("doc_id", "text")


def verified(pairs, docs):
    """The pairs (a, b) of node ids whose documents link. Only texts of documents in a pair move."""
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), docs)
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return kept(map_arrow(both, _verify, "a long, b long").distinct(), "links")


def _needed(n, other):
    """Shared signatures that a linked pair has at least, if all signatures of both are single tokens.

    Common tokens beyond the prefix that ends first are at most what is left of its
    document, so the rest of the needed overlap must be shared within the prefixes.
    """
    overlap = F.ceil((n + other) * PERCENT / F.lit(100 + PERCENT) - F.lit(1e-9))
    prefix = [size - F.ceil(size * PERCENT / F.lit(100) - F.lit(1e-9)) + 1 for size in (n, other)]
    return F.greatest(
        F.lit(1), F.least(*[overlap - (size - length) for size, length in zip((n, other), prefix, strict=True)])
    )


def near_duplicates(docs):
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counters = counters_for(docs.count())
    scan = kept(
        map_arrow(docs, _scan(counters), "doc_id long, n long, set_id binary, chunk int, counts binary"), "shingles"
    )
    sets = scan.filter("chunk IS NULL").select("doc_id", "n", "set_id")
    total, tokens = sets.agg(F.count(F.lit(1)), F.sum("n")).first()
    heavy = spark.sparkContext.broadcast(frequent_counters(scan, tokens or 0, counters))

    nodes = kept(
        sets.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("size")),
        "nodes",
    )
    # Only nodes give signatures: the other documents of their sets are left out before.
    others = (
        join_groups(sets.filter("doc_id IS NOT NULL"), nodes.filter("copies > 1"), "set_id", "copies", max(total, 1))
        .filter(F.col("doc_id") != F.col("node"))
        .select("doc_id")
        .distinct()
        .join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_anti")
    )
    given = kept(
        map_arrow(
            drop_ids(docs.filter("doc_id IS NOT NULL"), others),
            _signature_rows(heavy),
            "doc_id long, n int, single boolean, signatures array<long>",
        ).filter(F.size("signatures") > 0),
        "signatures",
    )
    links = _links(given, docs)
    groups = nodes.join(connected(links), "node", "left").select(
        "set_id", "copies", F.least(F.coalesce("component", "node"), "node").alias("component")
    )
    out = join_groups(sets, groups, "set_id", "copies", max(total, 1))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _links(given, docs):
    """Links enough to join every two linked nodes into one component."""
    entries = given.select(F.explode("signatures").alias("signature"), F.col("doc_id").alias("node"), "n", "single")
    lists = (
        entries.groupBy("signature")
        .agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .filter(F.col("first") < F.col("last"))
    )
    shared = kept(entries.join(lists.select("signature", "first"), "signature"), "lists")
    alone = F.col("signature") % 2 == 0
    rare = shared.filter(alone).drop("first")
    paired = shared.filter(~alone)

    # Lists with the same first node hold mostly the same nodes: together they are one crowd around it.
    stars = kept(
        paired.filter(F.col("node") > F.col("first")).groupBy("first", "node").agg(F.min("n").alias("n")), "stars"
    )
    pairs = _counted(rare).unionByName(stars.select(F.col("first").alias("a"), F.col("node").alias("b")))
    links = verified(kept(pairs.distinct(), "pairs"), docs)

    placed = stars.join(connected(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = kept(placed, "placed")
    # A crowd is open while two of its members other than the first are in different components.
    open_crowds = (
        placed.groupBy("first")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select("first")
    )
    crowds = kept(placed.join(open_crowds, "first"), "crowds")
    return links.unionByName(_links_in_crowds(crowds, docs)) if crowds.take(1) else links


def _links_in_crowds(crowds, docs):
    """Links enough to join every two linked members of a crowd that are in different components.

    A crowd is cut into shares of about ``SHARE_TOKENS`` tokens by a hash of the node, and each
    two shares meet in a block; blocks give one link for each two components they join, not the pairs they compare.
    """
    sizes = crowds.groupBy("first").agg(F.ceil(F.sum("n") / F.lit(SHARE_TOKENS)).cast("int").alias("shares"))
    own = F.pmod(F.xxhash64("node"), F.col("shares")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("shares") - 1))
    placed = (
        crowds.join(sizes, "first")
        .withColumn("share", own)
        .withColumn("other", other)
        .withColumns({"low": F.least("share", "other"), "high": F.greatest("share", "other")})
    )
    texts = _texts_of(crowds.select(F.col("node").alias("doc_id")).distinct(), docs)
    rows = placed.join(texts, placed["node"] == texts["doc_id"]).select(
        "first", "low", "high", "share", "node", "component", "text"
    )
    found = rows.groupBy("first", "low", "high").applyInPandas(_block_links, "a long, b long")
    return kept(found.distinct(), "links")


def _block_links(pdf):
    """Linked pairs that join the components of a block as far as all of its pairs do, fewer than its members.

    A block of two shares compares the members of one with those of the other. Components that a link has joined are one from then on.
    """
    # Rows that share a node are one; their texts are compared each.
    sets = list(shingle_sets(pa.array(pdf["text"])))
    n = len(sets)
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), size)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[token] > 1
    token, owner = token[common], owner[common]
    order = np.argsort(token, kind="stable")
    holders = owner[order]  # the members that hold each common token, token by token
    ends = np.cumsum(np.bincount(token, minlength=len(times)))
    starts = ends - np.bincount(token, minlength=len(times))
    begin = np.searchsorted(owner, np.arange(n + 1))
    node, part, share = (pdf[c].to_numpy() for c in ("node", "component", "share"))
    part = part.copy()
    two = bool(pdf["low"].iloc[0] != pdf["high"].iloc[0])
    a, b = [], []
    for i in range(n):
        own = token[begin[i] : begin[i + 1]]
        length = ends[own] - starts[own]
        at = np.repeat(starts[own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        same = np.bincount(holders[at], minlength=n)
        hit = 100 * same >= PERCENT * (size[i] + size - same)
        hit &= part != part[i]
        if two:
            hit &= share != share[i]
        met, first = np.unique(part[hit], return_index=True)
        b += node[hit][first].tolist()
        a += [int(node[i])] * len(met)
        part[np.isin(part, met)] = part[i]
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _joined(members):
    """Pairs of a list's members whose sizes allow a link, the smaller node first."""
    left = members.select("signature", *[F.col(c).alias(f"a_{c}") for c in members.columns if c != "signature"])
    right = members.select("signature", *[F.col(c).alias(f"b_{c}") for c in members.columns if c != "signature"])
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return (
        left.join(right, "signature")
        .filter(F.col("a_node") < F.col("b_node"))
        .filter(small * 100 >= large * PERCENT)
    )


def _counted(rare):
    """Pairs that share as many single tokens as a link needs."""
    needed = F.when(F.col("a_single") & F.col("b_single"), _needed(F.col("a_n"), F.col("b_n"))).otherwise(1)
    return (
        _joined(rare)
        .groupBy(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        .agg(F.count(F.lit(1)).alias("found"), F.max(needed).alias("needed"))
        .filter(F.col("found") >= F.col("needed"))
        .select("a", "b")
    )
