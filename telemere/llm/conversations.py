"""Repair of damaged conversations over a suffix-shared automaton of their signatures.

A row's *mark* is one letter: what a repair may do with it. A conversation's signature is
its marks in order. Distinct signatures, sorted by their reversed text, are read as an
automaton that shares suffixes: what two neighbours have in common at the end is one run
of nodes, so each suffix is a node once, whatever number of conversations holds it. A node
keeps, for each state of the grammar, the cost to the end and the best next edit; an edit
points to a state of this node or the next, so a node is computed in constant time and
strings are compared through ranks. A conversation's audit is read off its first node.

Distinct signatures are dealt out by ranges of their reversed text, so only the nodes on
the path at a range's start exist twice. A task holds one path. The messages of one
conversation are hashed in order, as SHA-256 asks, while they stream by in sorted order:
a task holds one conversation's audit and one message.

Defined cases: a null role or text counts as one space, also in the key of the damage, as do
a null ``conv_id`` and ``turn`` there; rows with a null ``conv_id`` are one conversation.
Rows of one turn come in the order of role and text, repeated rows each count. An empty
role has no initial and fits nowhere. An empty table gives no rows. Columns other than
``conv_id``, ``turn``, ``role`` and ``text`` may have any name.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemere.llm.tables import fresh, join_groups, kept, map_arrow

WORD = r"[^\x20\x09-\x0D]"
# Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
# Grammar (s?(ua)+)?: the state after each initial, the role that a state asks for, and where a conversation may end.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ASKS = {0: "user", 1: "user", 2: "assistant", 3: "user"}
FINAL = (0, 3)
STATES = range(4)
# Marks: a row that must go; else its initial, in upper case where the text is truncated; x and X are other initials.
GONE = "-"


def prepare(conversations):
    """conv_id, turn, role, text as the operator reads them."""
    blank = F.lit(" ")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    )


def damage(rows):
    """``rows`` with the planted faults: dropped, emptied, cut, repeated and renamed by a hash of conversation and turn."""
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    kind = F.crc32(key.cast("binary")) % 20
    marked = rows.withColumn("_kind", kind).where("_kind <> 0")
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit(""))
        .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _ordered(*keys):
    return W.partitionBy(*keys).orderBy(F.asc_nulls_first("turn"), "role", "text", "copy")


def facts(rows):
    """Each row's place in its conversation, first fault, initial and mark; one shuffle by conversation."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    blank = ~F.col("text").rlike(WORD)
    cut = ~F.regexp_extract("text", rf"({WORD})[\x20\x09-\x0D]*\z", 1).isin(".", "!", "?")
    order = _ordered("conv_id")
    placed = rows.select(
        "*",
        F.row_number().over(order).alias("place"),
        F.lag(initial).over(order).alias("before"),
        initial.alias("initial"),
    )
    # The order within equal role and text is that of the conversation, so the shuffle by conversation serves here too.
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy("place")) > 1
    fault = F.when(blank, "blank").when(again, "duplicate").when(cut, "truncated")
    judged = placed.select("conv_id", "turn", "place", "before", "initial", known.alias("known"), fault.alias("fault"))
    return judged.select(
        "conv_id",
        "turn",
        "place",
        F.col("fault"),
        (F.col("before").isNotNull() & ~F.concat("before", "initial").isin("su", "ua", "au")).alias("illegal"),
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE))
        .when(F.col("fault") == "truncated", F.upper("known"))
        .otherwise(F.col("known"))
        .alias("mark"),
    )


def signatures(rows, everyone):
    """One row for each conversation of ``everyone``: counts of its faults and its signature."""
    none = {"turn": "long", "place": "int", "fault": "string", "illegal": "boolean", "mark": "string"}
    held = everyone.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()]).distinct()
    marks = F.sort_array(F.collect_list(F.when(F.col("mark").isNotNull(), F.struct("place", "mark"))))
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return (
        facts(rows)
        .unionByName(held)
        .groupBy("conv_id")
        .agg(
            F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
            *[F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")],
            F.count_if("illegal").alias("illegal"),
            F.array_join(F.transform(marks, lambda m: m["mark"]), "").alias("signature"),
        )
    )


class Node:
    """One suffix of signatures: for each grammar state the cost, the first edit, where it leads, and the suffix's rank."""

    __slots__ = ("best", "rank")

    def __init__(self, mark, after):
        """The node that reads ``mark`` and goes on at ``after``; without a mark, the end."""
        best = [None] * 4
        for state in STATES:
            if after is None:
                # An audit that ends here has no edit; it comes before any longer one.
                best[state] = (0, "", None, None, -1) if state in FINAL else None
            else:
                for cost, edit, to in _options(mark, state):
                    if after.best[to] is not None:
                        found = (cost + after.best[to][0], edit, after, to, after.rank[to])
                        if best[state] is None or _key(found) < _key(best[state]):
                            best[state] = found
        # Insertions lead to another state of the same node and cost something, so few rounds settle them.
        for _ in STATES:
            for state in STATES:
                to = NEXT[state][ASKS[state][0]]
                if best[to] is not None:
                    found = (INSERT + best[to][0], "I", None, to, None)
                    if best[state] is None or found[:2] < best[state][:2]:
                        best[state] = found
        self.best = best
        self.rank = self._ranks()

    def _spelled(self, state):
        """The suffix of a state as something that sorts like it: insertions, then the first edit that moves on."""
        inserted = []
        while self.best[state][1] == "I":
            inserted.append("I")
            state = self.best[state][3]
        _, edit, _, _, rank = self.best[state]
        return (*[(c, 0) for c in inserted], (edit, rank))

    def _ranks(self):
        spelled = [self._spelled(s) for s in STATES]
        order = {key: n for n, key in enumerate(sorted(set(spelled)))}
        return [order[key] for key in spelled]


def _key(found):
    return found[0], found[1], found[4]


def _options(mark, state):
    """(cost, edit, next state) for reading ``mark`` in ``state``."""
    yield DELETE, "D", state
    if mark == GONE:
        return
    extra = CUT if mark.isupper() else 0
    if mark.lower() in NEXT[state]:
        yield KEEP + extra, "K", NEXT[state][mark.lower()]
    yield REROLE + extra, "R", NEXT[state][ASKS[state][0]]


def _audits(batches):
    """Signatures in the order of their reversed text -> signature, cost, audit; one path of nodes is held."""
    path, last = [Node(None, None)], ""
    for batch in batches:
        costs, audits = [], []
        column = batch.column(0).to_pylist()
        for signature in column:
            reversed_ = signature[::-1]
            shared = 0
            for a, b in zip(last, reversed_, strict=False):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for mark in reversed_[shared:]:
                path.append(Node(mark, path[-1]))
            last = reversed_
            node, state, audit = path[-1], 0, []
            costs.append(node.best[0][0])
            while node.best[state][1]:
                _, edit, to, after, _ = node.best[state]
                audit.append(edit)
                node, state = to or node, after
            audits.append("".join(audit))
        yield pa.record_batch(
            [pa.array(column, pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            names=["signature", "cost", "audit"],
        )


def audits(signed):
    """signature, holders, cost, audit for each distinct signature of ``signed``."""
    distinct = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("holders"))
    backwards = F.reverse("signature")
    solved = map_arrow(
        distinct.select("signature", backwards.alias("backwards")).repartitionByRange("backwards")
        .sortWithinPartitions("backwards").select("signature"),
        _audits,
        "signature string, cost long, audit string",
    )
    return distinct.join(solved, "signature")


def _hashes(batches):
    """Rows in order of conversation and place, a conversation's audit first -> its audit row's number and its hash."""
    out = None
    for batch in batches:
        done = []
        for number, audit, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if audit is not None:
                if out is not None:
                    done.append(out.closed())
                out = _Repaired(number, audit)
            else:
                out.row(role, text)
        if done:
            yield _hash_batch(done)
    if out is not None:
        yield _hash_batch([out.closed()])


def _hash_batch(done):
    numbers, digests = zip(*done, strict=True)
    return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(digests, pa.string())], names=["number", "sha256"])


class _Repaired:
    """The hash of one conversation while its rows pass."""

    def __init__(self, number, audit):
        self.number, self.edits, self.at, self.state = number, audit, 0, 0
        self.hash, self.joint = hashlib.sha256(), b""

    def _say(self, role, text):
        self.hash.update(self.joint)
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.joint = b"\n"
        self.state = NEXT[self.state][role[0]]

    def _insertions(self):
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._say(ASKS[self.state], "")
            self.at += 1

    def row(self, role, text):
        self._insertions()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else ASKS[self.state], text)

    def closed(self):
        self._insertions()
        return self.number, self.hash.hexdigest()


def repair(conversations):
    """Cheapest repair of each conversation as it stands: its counts of faults, cost, audit and the repaired text's hash.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    rows = prepare(conversations).withColumn("copy", F.lit(0))
    return _repair(rows, rows)


def repair_damaged(conversations):
    """:func:`repair` of the conversations after :func:`damage`, one row for each there was before."""
    rows = prepare(conversations)
    return _repair(damage(rows), rows)


def _repair(rows, everyone):
    signed = kept(signatures(rows, everyone.select("conv_id")), "signed")
    solved = kept(audits(signed), "audits")
    total = signed.count()
    answered = join_groups(signed, solved, "signature", "holders", total).drop("signature", "holders")
    # A number instead of the id travels with the rows' hashes, so ids may be of any type.
    number = fresh("number")
    answered = kept(answered.withColumn(number, F.monotonically_increasing_id()), "answered")
    heads = answered.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.col(number).alias("number"),
        "audit",
        *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copy", "int"))],
    )
    body = rows.select(
        "conv_id", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("number"), F.lit(None).cast("string").alias("audit"),
        "turn", "role", "text", "copy",
    )
    streamed = (
        heads.unionByName(body)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "text", "copy")
        .select("number", "audit", "role", "text")
    )
    hashed = map_arrow(streamed, _hashes, "number long, sha256 string")
    return answered.join(hashed, answered[number] == hashed["number"]).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha256").alias("repaired_sha256"),
    )
