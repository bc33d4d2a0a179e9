"""Words and shingles of many texts at once, with NumPy.

An Arrow string column holds its texts end to end in one buffer. Words are found by comparing
neighbouring bytes of that buffer, hashed to 64 bits by sums over the bytes of each word, and runs
of words are hashed from the words' hashes. Nothing here runs Python code for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Text bytes handled at a time; a longer text is handled alone.
CHUNK = 1 << 19


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit of the result depends on every bit given."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_BYTE = _mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(64, 2 * n), U(0x100000001B3 * 2 + 1), dtype=U)
        steps[0] = 1
        _POWERS = np.cumprod(steps)
    return _POWERS


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return at, (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))


def chunks(at: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or of one text."""
    a = 0
    while a < len(at) - 1:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, side="right")) - 1)
        yield a, b
        a = b


def word_spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data[at[0]:at[-1]]``, relative to ``at[0]``, and the number of
    words that begin before each text. ``inside`` marks the bytes of words (else: all that isn't blank)."""
    part = data[at[0]:at[-1]]
    edge = at - at[0]
    inside = ~_SPACE[part] if inside is None else inside
    if not len(part):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(at), np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    first = edge[:-1][edge[:-1] < edge[1:]]  # of texts that aren't empty
    begin[first] = inside[first]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = first_last = edge[1:][edge[:-1] < edge[1:]] - 1
    end[last] = inside[first_last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, edge)


def hash_spans(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the disjoint, ascending, non-empty spans of ``part``."""
    if not len(starts):
        return np.zeros(0, U)
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    rel = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(firsts, sizes)
    at = rel + np.repeat(starts, sizes)
    terms = _BYTE[part[at]] * _powers(int(sizes.max()))[rel]
    return _mix(np.add.reduceat(terms, firsts) + sizes.astype(U))


def lowered(part: np.ndarray) -> np.ndarray:
    return _LOWER[part]


def shingles(words: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words of each text (of all its words if there are fewer), and the
    number of hashes before each text. Repeats are kept."""
    n = len(words)
    counts = np.diff(before)
    long = counts >= k
    made = np.where(long, counts - k + 1, (counts > 0).astype(np.int64))
    ahead = np.concatenate([[0], np.cumsum(made)])
    if not n:
        return np.zeros(0, U), ahead
    runs = np.zeros(max(n - k + 1, 0), U)
    for i in range(k):
        runs += _mix(words[i:n - k + 1 + i] + U(i + 1)) if n >= k else U(0)
    out = np.empty(int(ahead[-1]), U)
    # the first word of each run
    text = np.repeat(np.arange(len(counts)), made)
    at = before[:-1][text] + (np.arange(len(out)) - ahead[:-1][text])
    is_long = long[text]
    out[is_long] = runs[at[is_long]]
    for t in np.flatnonzero(~long & (counts > 0)):  # texts of one to k - 1 words
        own = words[before[t]:before[t + 1]]
        out[ahead[t]] = sum((int(_mix(own[i:i + 1] + U(i + 1))[0]) for i in range(len(own))), 0x5851F42D4C957F2D * len(own)) & 0xFFFFFFFFFFFFFFFF
    return _mix(out), ahead


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of some texts, and the number of words before each text."""
    starts, ends, before = word_spans(data, at)
    return hash_spans(lowered(data[at[0]:at[-1]]), starts, ends), before
