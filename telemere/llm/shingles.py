"""Distinct word shingles of whole texts as 64-bit hashes, by few numpy calls for many texts."""

import numpy as np
import pyarrow as pa

SIZE = 5
BLOCK_BYTES = 1 << 20
SPACES = [0x20, *range(0x09, 0x0E)]

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
for _upper in range(ord("A"), ord("Z") + 1):
    _BYTE[_upper] = _BYTE[_upper + 32]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, SIZE + 1, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[SPACES] = True


def mix(h):
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)


def _powers(n):
    """1, BASE, BASE ** 2 ... modulo 2 ** 64."""
    global _POWERS
    if len(_POWERS) < n:
        made = np.full(max(n, 1 << 16), _BASE, np.uint64)
        made[0] = 1
        _POWERS = np.cumprod(made, dtype=np.uint64)
    return _POWERS[:n]


def distinct(hashes):
    """Sorted, each once."""
    hashes = np.sort(hashes)
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    return hashes[keep]


def _block(data, starts, ends):
    """Sorted distinct shingle hashes of each text data[starts[i]:ends[i]]."""
    space = _IS_SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = space[:-1]
    edge[starts[starts < len(data)]] = True
    first = np.flatnonzero(~space & edge[:-1])
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[-1:] = True
    after[ends[ends > 0] - 1] = True
    last = np.flatnonzero(~space & after) + 1
    # Each word's hash is a polynomial in its bytes; highest power first, so that its place does not matter.
    longest = int((last - first).max()) if len(first) else 0
    word = np.zeros(len(first), np.uint64)
    values = _BYTE[data]
    if longest <= 64:
        live, place, size = np.arange(len(first)), first, last - first
        for k in range(longest):
            if k and (size == k).any():
                more = size > k
                live, place, size = live[more], place[more], size[more]
            if len(live) == len(word):
                word = word * _BASE + values[place + k]
            else:
                word[live] = word[live] * _BASE + values[place + k]
    else:
        power = _powers(longest + 1)
        size = last - first
        owner = np.repeat(np.arange(len(first)), size)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        terms = values[first[owner] + step] * power[size[owner] - 1 - step]
        word = np.add.reduceat(terms, np.cumsum(size) - size) if len(first) else word
    word = mix(word + (last - first).astype(np.uint64) * _PLACE[SIZE])
    lo = np.searchsorted(first, starts)
    hi = np.searchsorted(first, ends)
    rolled = word * _PLACE[0]
    for k in range(1, SIZE):
        rolled[: len(word) - k] += word[k:] * _PLACE[k]
    rolled = mix(rolled + np.uint64(SIZE))
    out = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        n = b - a
        if n >= SIZE:
            out.append(distinct(rolled[a : b - SIZE + 1]))
        elif n:
            whole = (word[a:b] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(column):
    """Yield the sorted distinct shingle hashes of each text of an Arrow string column; null gives none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = np.asarray(column.is_null())
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1
        to = min(max(to, at + 1), n)
        lo = offsets[at]
        starts, ends = offsets[at:to] - lo, offsets[at + 1 : to + 1] - lo
        yield from _block(data[lo : offsets[to]], starts, np.where(null[at:to], starts, ends))
        at = to
