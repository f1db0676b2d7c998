"""The repair of conversations as SQL: the grammar's costs, from each conversation's last row to its first."""

# The bit-reversed polynomial of CRC-32, and its start and final mask.
_POLYNOMIAL, _MASK = 3988292384, 4294967295


def _crc32(text):
    """CRC-32 of an ASCII text: a byte at a time, eight bits each."""
    bits = f"list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, {_POLYNOMIAL} * (x & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(({text})[i]) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda crc, byte: {bits}, CAST({_MASK} AS BIGINT)), {_MASK})"


def _step(after, cost, edit, line=None):
    """The way through ``after``, behind one more edit: its key is nine digits of cost and the audit."""
    key = f"lpad(CAST(CAST({after}.k[:9] AS INT) + {cost} AS VARCHAR), 9, '0') || '{edit}' || {after}.k[10:]"
    lines = f"list_prepend({line}, {after}.t)" if line else f"{after}.t"
    return f"struct_pack(k := {key}, t := {lines})"


# What each state asks for next, and the state behind it.
_ASKS = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _insert(state, after):
    return _step(after, 2, "I", f"'{_ASKS[state][0]}:'")


def _read(state):
    """The best way of reading a row in a state."""
    role, behind = _ASKS[state]
    ways = [_step(f"v{state}", 3, "D"), f"CASE WHEN free THEN {_step(f'v{behind}', '2 + cut', 'R', f"'{role}:' || text")} END"]
    for initial, to in _KEEPS[state].items():
        kept = _step(f"v{to}", "cut", "K", "role || ':' || text")
        ways.append(f"CASE WHEN free AND initial = '{initial}' THEN {kept} END")
    return f"least({', '.join(ways)}) AS c{state}"


REPAIR = f"""
WITH RECURSIVE source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, copy,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM source JOIN (VALUES (0), (1)) AS copies(copy) ON kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER w AS place, lag(left(role, 1)) OVER w AS before
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), judged AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
        WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
        END AS fault
    FROM placed
), marked AS (
    SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS free,
        CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut
    FROM judged
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), ways AS (
    SELECT conv_id, n + 1 AS place, v3 AS v0, {_insert(1, "v2")} AS v1, v2, v3
    FROM (SELECT *, {_insert(2, "v3")} AS v2
        FROM (SELECT conv_id, n, struct_pack(k := '000000000', t := CAST([] AS VARCHAR[])) AS v3 FROM counted))
    UNION ALL
    SELECT conv_id, place, least(c0, {_insert(0, "u")}), least(c1, {_insert(1, "u")}), u, least(c3, {_insert(3, "c2")})
    FROM (SELECT *, least(c2, {_insert(2, "c3")}) AS u
        FROM (SELECT m.conv_id, m.place, {", ".join(_read(s) for s in range(4))}
            FROM ways JOIN marked m ON m.conv_id IS NOT DISTINCT FROM ways.conv_id AND m.place = ways.place - 1))
), everyone AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(CAST(v0.k[:9] AS BIGINT), 0) AS cost, coalesce(v0.k[10:], '') AS audit,
    coalesce(sha256(array_to_string(v0.t, chr(10))), sha256('')) AS repaired_sha256
FROM everyone e
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND w.place = 1
"""
