"""Blocks of whole texts as code arrays, so that tasks work on many texts with few numpy calls."""

import numpy as np

BLOCK_CHARS = 1 << 20


def blocks(texts, limit=BLOCK_CHARS):
    """Consecutive runs of ``texts`` of about ``limit`` characters; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def codes(texts):
    """Code points of ``texts``, a line feed after each, and the end of each text in that array."""
    joined = "\n".join(texts) + "\n"
    array = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return array, ends
