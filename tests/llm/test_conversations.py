import hashlib
import itertools
import random
import re
import zlib

from telemere.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, place int, number string, audit int, copy int"
FLOW = {0: "su", 1: "u", 2: "a", 3: "u"}
TO = {"s": 1, "u": 2, "a": 3}
WORD = "[^\x20\x09-\x0d]"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows, everyone):
    """What each conversation's repair must be, by trying every edit of every row."""
    out = {}
    for conv in {r[0] for r in everyone}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            words = re.findall(WORD, text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else None
            faults.append(fault or ("truncated" if words[-1] not in ".!?" else None))
            seen.add((role, text))
        # From the last row to the first: for each state the least (cost, audit) and its lines.
        best = {0: (0, "", []), 3: (0, "", [])}
        best[2] = (2, "I", ["assistant:"])
        best[1] = (4, "II", ["user:", "assistant:"])
        for (_, _, role, text), fault in zip(mine[::-1], faults[::-1], strict=True):
            now = {}
            for state in range(4):
                cost, audit, lines = best[state]
                ways = [(cost + 3, "D" + audit, lines)]
                if fault not in ("blank", "duplicate"):
                    for edit, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                        if name[:1] and name[:1] in FLOW[state]:
                            cost, audit, lines = best[TO[name[0]]]
                            ways.append((cost + price + (fault == "truncated"), edit + audit, [f"{name}:{text}", *lines]))
                now[state] = min(ways)
            for _ in range(4):
                for state, name in itertools.product(range(4), ("user", "assistant")):
                    if name[0] in FLOW[state]:
                        cost, audit, lines = now[TO[name[0]]]
                        now[state] = min(now[state], (cost + 2, "I" + audit, [f"{name}:", *lines]))
            best = now
        cost, audit, lines = best[0]
        turns = [r[1] for r in mine if r[1] is not None]
        legal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            legal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def answers(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_rows(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "unknown", None]
    texts = ["One. ", "Two!", "three", "", " \t", None, "Four?\n", "five, ."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv, turn, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.6 else f"say {rng.random()}."))
    return rows


def test_equals_plain_repair(spark):
    rows = random_rows(150, 1)
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None."), *rows[:40]]
    assert answers(conversations.repair_damaged(table(spark, rows))) == plain(damaged(rows), rows)
    given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert answers(conversations.repair(table(spark, rows))) == plain(given, rows)


def test_every_short_signature(spark):
    marks = [("system", "a."), ("user", "b."), ("assistant", "c."), ("tool", "d."), ("user", "e"), ("assistant", "")]
    rows = []
    for conv, pick in enumerate(itertools.product(marks, repeat=4)):
        rows += [(conv, turn, role, text and f"{turn}{text}") for turn, (role, text) in enumerate(pick)]
    assert answers(conversations.repair(table(spark, rows))) == plain(rows, rows)


def test_long_conversation_and_long_text(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(20_000)] + [(2, 0, "user", "x" * 3_000_000)]
    got = answers(conversations.repair(table(spark, rows)))
    assert got[1][:6] == (0, 0, 0, 0, 0, 0) and got[1][6] == "K" * 20_000
    # Keeping the cut row costs one and a reply two; only then deleting it costs as much, and its audit comes first.
    assert got[2][5:7] == (3, "D")


def test_all_rows_dropped_and_no_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = answers(conversations.repair_damaged(table(spark, [(gone, 0, "user", "Hello.")])))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert answers(conversations.repair_damaged(table(spark, []))) == {}


def test_query_is_registered():
    assert "op11_conversations" in queries.QUERIES and "op11_conversations" in queries.ORACLES
