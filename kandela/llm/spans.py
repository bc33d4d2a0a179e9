"""Substring dedup by sliding sentence spans.

A sentence ends with a word that closes with ``.``, ``!`` or ``?``, before a line feed, and at the end of
the text. Only sentences of more than ``LONG`` words have further ends inside, after every word whose hash is the
smallest of some ``WINDOW`` words in a row there (the first of equal ones). So text without such signs has an end in every
``WINDOW`` words, at places that hang on the words around alone. Spans are the shortest runs of whole sentences, of
all that begin with a sentence and of all that end with one, that have ``MIN_WORDS`` words: two sentences or more,
as none is that long. So a repeated passage of whole sentences is covered from its first to its last, and one
of 51 words holds a whole span wherever its sentences end and wherever it
begins, but for rare cases (see the test). Spans are compared by a 64-bit hash of their lower-cased words; blanks
don't matter. The first occurrence of a span is the one in the document with the smallest doc_id, there
the earliest. Sentences that any other occurrence covers are removed, with the blanks behind them. So a passage that
repeats stays once, and text without repeated spans stays byte for byte.

1. Every span's hash and doc_id: those hashes that occur more than once, with their smallest doc_id (combined
   before the shuffle, so a span that a third of the documents share is no hot group).
2. A second pass over the texts gives the places of all spans; a join keeps those of repeated hashes (Spark
   splits a hot hash). Those of other documents are to be removed.
3. Of the few in the document with the smallest doc_id, the first place of a hash is a minimum again, and the
   others are to be removed.
4. Documents get the list of their spans to remove, at most two for each of their sentences.

The work is the same at every size: a small row for each span is shuffled twice.

Null and empty texts have no spans and stay. Rows of the same doc_id and text are the same document: they
get the same removals and don't remove each other's text. Rows of one doc_id with different texts are
different documents, in the order of a hash of the text. Every row without a doc_id is a document of its
own after all others; such rows are written with a running number first. Texts shorter than a span stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import set_aside, stage
from .words import U, _mix, chunks, hash_spans, lowered, texts_of, word_spans

MIN_WORDS = 25
#: Sentences of more words have further ends inside, one in every WINDOW words at least.
LONG, WINDOW = 14, 8
#: A span's place: its first sentence, and in the last bits its number of sentences (at most MIN_WORDS).
MANY_BITS = 6

_BASE = 0x9E3779B97F4A7C15 | 1
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def sentences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of some texts: the place of each sentence's first byte (relative to ``at[0]``), its hash, its number
    of words, and the number of sentences before each text."""
    part = data[at[0]:at[-1]]
    starts, ends, before = word_spans(data, at)
    n = len(starts)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(U), empty, np.zeros(len(at), np.int64)
    words = hash_spans(lowered(part), starts, ends)
    lines = np.concatenate([[0], np.cumsum(part == 10)])
    stop = _STOP[part[ends - 1]]
    stop[:-1] |= lines[starts[1:]] > lines[ends[:-1]]
    stop[before[1:][np.diff(before) > 0] - 1] = True
    last = np.flatnonzero(stop)
    stop[inner_ends(words, last)] = True
    last = np.flatnonzero(stop)
    first = np.concatenate([[0], last[:-1] + 1])
    size = last - first + 1
    place = np.arange(n) - np.repeat(first, size)
    hashes = _mix(np.add.reduceat(_mix(words + place.astype(U) * U(_BASE)), first) + size.astype(U))
    return starts[first], hashes, size, np.searchsorted(first, before)


def inner_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The words that end something inside long sentences; ``last``: the last word of each sentence."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64)
    of = np.searchsorted(last, np.arange(len(words)))
    long = np.diff(last, prepend=-1) > LONG
    at = np.flatnonzero(long[of[:1 - WINDOW]] & (of[:1 - WINDOW] == of[WINDOW - 1:]))
    return np.unique(at + np.lib.stride_tricks.sliding_window_view(words, WINDOW)[at].argmin(axis=1))


def spans(hashes: np.ndarray, size: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every span: its first sentence, its number of sentences, its hash; first those by their beginnings."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), hashes
    words = np.concatenate([[0], np.cumsum(size)])
    end = np.searchsorted(words, words[:-1] + MIN_WORDS)
    many = np.diff(ahead)
    first = np.flatnonzero(end <= np.repeat(ahead[1:], many))
    # the shortest ones that end with a sentence, where they aren't the shortest that begin with one
    begin = np.searchsorted(words, words[1:] - MIN_WORDS, side="right") - 1
    last = np.flatnonzero((begin >= np.repeat(ahead[:-1], many)) & (end[begin] != np.arange(1, n + 1)))
    first, end = np.concatenate([first, begin[last]]), np.concatenate([end[first], last + 1])
    steps = np.full(n, U(_BASE))
    steps[0] = 1
    power = np.cumprod(steps)
    steps[1:] = U(pow(_BASE, -1, 1 << 64))
    back = np.cumprod(steps)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(hashes * power)])
    return first, end - first, _mix((sums[end] - sums[first]) * back[first] + (end - first).astype(U))


#: What names a document: its id, and a hash of its text (of a row without an id: its running number).
NAME = ["doc_id", "text_key"]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, data = texts_of(batch.column("text"))
        for a, b in chunks(at):
            _, hashes, size, ahead = sentences(data, at[a:b + 1])
            first, many, h = spans(hashes, size, ahead)
            row = np.searchsorted(ahead, first, side="right") - 1
            at_row = pa.array(a + row)
            place = ((first - ahead[row]) << MANY_BITS) + many
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(batch.column(c).take(at_row) for c in NAME), pa.array(place)], names=["h", *NAME, "place"])


def _rewritten(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gone = batch.column("text"), batch.column("gone")
            mask = pc.is_valid(gone).to_numpy(zero_copy_only=False)
            removed, words_removed, new = np.zeros(len(mask), np.int64), np.zeros(len(mask), np.int64), []
            for i in np.flatnonzero(mask):
                at, data = texts_of(text.slice(i, 1))
                first, _, size, _ = sentences(data, at)
                out = np.zeros(len(first), bool)
                for place in gone[i].as_py():
                    pos = place >> MANY_BITS
                    out[pos:pos + (place & (1 << MANY_BITS) - 1)] = True
                raw = data[at[0]:at[1]].tobytes()
                edges = np.append(first, len(raw))
                keep = [raw[:edges[0]]] + [raw[edges[k]:edges[k + 1]] for k in np.flatnonzero(~out)]
                new.append(b"".join(keep).decode())
                removed[i], words_removed[i] = out.sum(), size[out].sum()
            if len(new):
                text = pc.replace_with_mask(text, pa.array(mask), pa.array(new, text.type))
            yield pa.RecordBatch.from_arrays([*(text if c == "text" else batch.column(c) for c in names), pa.array(removed), pa.array(words_removed)], names=[*names, "n_removed", "words_removed"])
    return run


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text_key``; the rows without a doc_id are read from the shared folder,
    so that their numbers stay the same in all passes."""
    none = stage(docs.where("doc_id is null").withColumn("text_key", F.monotonically_increasing_id()), "no-id")
    return docs.where("doc_id is not null").withColumn("text_key", F.xxhash64("text")).unionAll(none)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """NAME, ``place``: spans to be removed."""
    texts = texts.select(*NAME, "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(_occurrences, f"h long, doc_id {kind}, text_key long, place long")
    firsts = stage(found.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("c")).where("c > 1").drop("c"), "firsts")
    again = stage(found.join(firsts, "h").select("h", *NAME, "place", F.col("doc_id").eqNullSafe(F.col("first_id")).alias("may_be_first")), "repeated")
    order = F.struct("text_key", "place")
    within = again.where("may_be_first")
    first = stage(within.groupBy("h").agg(F.min(order).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "first-places")
    return again.where("not may_be_first").select(*NAME, "place").unionAll(within.join(first, "h").where(order != F.col("first")).select(*NAME, "place"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated spans cut out of ``text``, and ``n_removed`` sentences, ``words_removed``."""
    plain, back = set_aside(docs, "doc_id", "text")
    plain = plain.withColumn("text", F.col("text").cast("string"))
    names = plain.columns
    schema = StructType([*plain.schema.fields, StructField("n_removed", LongType()), StructField("words_removed", LongType())])
    named = _named(plain)
    gone = repeated_spans(named).groupBy(*NAME).agg(F.collect_set("place").alias("gone"))  # at most two for each of a text's sentences
    same = F.lit(True)
    for c in NAME:
        gone = gone.withColumnRenamed(c, f"of_{c}")
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    rows = named.join(gone, same, "left").select(*names, "gone")
    out = rows.mapInArrow(_rewritten(names), schema)
    return out.select(*back, "n_removed", "words_removed")
