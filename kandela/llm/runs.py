"""Periodic runs of words by maximal pairs.

A run is a stretch of words with smallest period q (words q apart are equal) and at least ``max(LEAST,
2 q)`` words that no neighbouring word extends. Let two places q apart be followed by the same L words,
with different words (or an end of the text) before and behind: a maximal pair. If q <= L, the q + L
words from the first place are a run of period q that can't be extended, so nothing is extended here;
and every run is such a pair of its start and the place one period on. A pair at a multiple of a run's
period gives the same stretch, of which the smallest period is kept.

1. Words are hashed (64 bits). A pair has L >= LEAST / 2, so only places whose next LEAST / 2 words occur
   again in the text can be in one. Most texts have none, and are done.
2. For the others suffix ranks come from prefix doubling, and common prefixes of neighbours in that order
   (LCP) from the same ranks, both with NumPy.
3. The intervals of places that share L >= LEAST / 2 words are built bottom-up from the LCP values, with
   a stack. An interval holds its places in order, all of them and by the word on their left. When a
   smaller interval is merged into a larger one, every place of the smaller looks among the larger's
   places up to L words away for those with another word on the left; a stretch with the same one is
   passed over at once by comparing the two lists. So work is the number of pairs found, which runs
   bound linearly, plus a few bisections for each merged place.

Results: a null or blank text has no words and no run; null doc_ids are values like any other and
repeated rows get a row each. Texts are taken whole, whatever their length: a text is handled in one
task, in memory in proportion to its words. Ties for the longest run go to the smallest start, then
the smallest period. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow
from .words import U, _mix, chunks, hash_spans, texts_of, word_spans

LEAST = 12


class _Interval:
    """Places that share a prefix: all in order, and in order by the word on their left."""

    __slots__ = ("by_left", "places")

    def __init__(self, place: int, left: int):
        self.places, self.by_left = [place], {left: [place]}

    def others(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places up to ``reach`` away whose word on the left isn't ``left``."""
        places, same = self.places, self.by_left.get(left)
        at, end = bisect_left(places, place - reach), bisect_right(places, place + reach)
        if same is None:
            yield from places[at:end]
            return
        own = bisect_left(same, places[at]) if at < end else 0
        while at < end:
            if own == len(same) or places[at] < same[own]:
                yield places[at]
                at += 1
                continue
            # both lists agree for as long as the left word is the same: double the step, then halve it
            step, most = 1, min(end - at, len(same) - own)
            while step < most and places[at + step] == same[own + step]:
                step *= 2
            low, high = step // 2, min(step, most)
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if places[at + mid] == same[own + mid] else (low, mid)
            at, own = at + low + 1, own + low + 1

    def take(self, other: _Interval) -> None:
        """Adds the places of a smaller interval."""
        if 4 * len(other.places) > len(self.places):
            self.places = sorted(self.places + other.places)  # two ascending stretches: one merge
        else:
            for p in other.places:
                insort(self.places, p)
        for left, places in other.by_left.items():
            mine = self.by_left.setdefault(left, [])
            if not mine:
                self.by_left[left] = places
            elif 4 * len(places) > len(mine):
                self.by_left[left] = sorted(mine + places)
            else:
                for p in places:
                    insort(mine, p)


def _suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of what follows them, and the common words of each and the one before it."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64) + 1]
    width = 1
    while ranks[-1].max() < n:
        r = ranks[-1]
        key = r * (n + 1)
        key[:n - width] += r[width:]
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        ordered = key[order]
        new[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        ranks.append(new)
        width *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1] - 1] = np.arange(n)
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 2, -1, -1):
        fits = np.flatnonzero((np.maximum(a, b) + (1 << k) <= n) & (np.minimum(a, b) < n))
        same = fits[ranks[k][a[fits]] == ranks[k][b[fits]]]
        a[same] += 1 << k
        b[same] += 1 << k
        common[1 + same] += 1 << k
    return order, common


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of ``words`` (integers), by start and period."""
    half, n = -(-least // 2), len(words)
    if n < least:
        return []
    order, common = _suffix_order(words)
    left = np.empty(n, np.int64)  # the word before each place; before the first there is none
    left[0], left[1:] = -1, np.unique(words, return_inverse=True)[1][:-1]
    runs: dict[tuple[int, int], int] = {}

    def merged(one: _Interval, two: _Interval, shared: int) -> _Interval:
        if len(one.places) < len(two.places):
            one, two = two, one
        for before, places in two.by_left.items():
            for p in places:
                for o in one.others(p, before, shared):
                    period = abs(p - o)
                    if period + shared >= least:
                        key = (min(p, o), period + shared)
                        if runs.get(key, n) > period:
                            runs[key] = period
        one.take(two)
        return one

    deep = np.flatnonzero(common >= half)
    # neighbours in the order that share too little part it
    for group in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1) if len(deep) else ():
        first = int(order[group[0] - 1])
        stack: list[tuple[int, _Interval]] = []  # what an interval shares with the next one, and the interval
        top = _Interval(first, int(left[first]))
        for place, shared in zip(order[group].tolist(), common[group].tolist(), strict=True):
            while stack and stack[-1][0] > shared:
                depth, below = stack.pop()
                top = merged(below, top, depth)
            stack.append((shared, top))
            top = _Interval(place, int(left[place]))
        while stack:
            depth, below = stack.pop()
            top = merged(below, top, depth)
    return sorted(((s, length, q) for (s, length), q in runs.items()), key=lambda r: (r[0], r[2]))


def _repeats(h: np.ndarray, before: np.ndarray, k: int) -> np.ndarray:
    """Whether each text has ``k`` words in a row that come again in it."""
    out = np.zeros(len(before) - 1, bool)
    if len(h) < k + 1:
        return out
    grams = np.zeros(len(h) - k + 1, U)
    for i in range(k):
        grams += _mix(h[i:len(h) - k + 1 + i] + U(i + 1))
    text = np.searchsorted(before, np.arange(len(grams)), side="right") - 1
    whole = np.arange(len(grams)) + k <= before[text + 1]
    keys, text = _mix(grams[whole] + _mix(text[whole].astype(U) + U(77))), text[whole]
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    out[text[order[same]]] = True
    return out


def damage(n: int, doc_id) -> np.ndarray | None:
    """Places of the original words that stand at each of the ``n`` places, for one document in ten (by
    the checksum of its id): from some place on, the first few words again and again. None: unchanged,
    as is a text without an id."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def _found(least: int, damaged: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            at, data = texts_of(batch.column("text"))
            for a, b in chunks(at):
                part = data[at[a]:at[b]]
                starts, ends, before = word_spans(data, at[a:b + 1])
                h = hash_spans(part, starts, ends)
                places = [damage(int(before[i + 1] - before[i]), ids[a + i]) if damaged else None for i in range(b - a)]
                check = _repeats(h, before, -(-least // 2))
                found, kept = [], []
                raw = part.tobytes()
                for i in range(b - a):
                    own, new = h[before[i]:before[i + 1]], places[i]
                    runs = []
                    if check[i] or new is not None:
                        runs = find_runs(own if new is None else own[new], least)
                    words = raw[at[a + i] - at[a]:at[a + i + 1] - at[a]].split()
                    if new is not None:
                        words = [words[j] for j in new.tolist()]
                    if runs:
                        drop = np.zeros(len(words) + 1, np.int64)
                        for s, length, q in runs:
                            drop[s + q] += 1
                            drop[s + length] -= 1
                        words = [w for w, d in zip(words, np.cumsum(drop).tolist(), strict=False) if not d]
                    found.append([{"start": s, "length": length, "period": q} for s, length, q in runs])
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(found, _RUNS), pa.array(kept, pa.string())], names=["doc_id", "runs", "collapsed"])
    return run


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, least: int = LEAST, damaged: bool = False) -> DataFrame:
    """``doc_id, runs, collapsed`` of each row of ``docs``: its runs by start and period, and its words,
    joined by blanks, without those that a run holds after its first period."""
    docs = narrow(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_found(least, damaged), f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def run_digests(docs: DataFrame, least: int = LEAST, damaged: bool = True) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``: the
    longest run of each row, and digests of all its runs and of its collapsed words."""
    found = periodic_runs(docs, least, damaged)
    # the greatest of (length, -start, -period) is the longest, then first, then shortest-period run
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return out.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                      F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
                      F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
