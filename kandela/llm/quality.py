"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Tokens are runs of letters and digits (any byte beyond ASCII counts as a letter), and runs of other
signs. Features are single tokens and pairs of neighbours, hashed to 2^BITS places: by their
lower-cased bytes, and by their shape (kind of sign, case, length). A pair of equal tokens has one
place of its own, whatever the token. A feature's value is its share of the text's features of the
same kind, so long texts count as much as short ones; a score is a sparse dot product and the
logistic function.

Training is FTRL-Proximal with L1 and L2 penalties, in ``EPOCHS`` passes over a bounded sample: the
``MAX_TRAIN`` labelled rows with the smallest hash of doc_id (a documented bound; every text is
scored). The sample is split by hash into ``PARTS`` parts; each is learned in its own task, and the
weights are averaged. A part with fewer rows weighs less.

Labels of rows whose crc32(doc_id as text) mod 3 is 1 are held out and never read for training.
Labels, lang, source and doc_id are no inputs of a score. A null or empty text has no features and
gets the score of the bias alone. Rows without a doc_id are not held out and are scored like others.
Null labels don't train; with several labels for a doc_id each counts; without any labels every
weight is 0 and every score 0.5. Repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import narrow, set_aside, stage
from .words import U, _mix, chunks, hash_spans, lowered, texts_of

BITS, MAX_TRAIN, PARTS, EPOCHS = 18, 8192, 4, 3
#: Learning rate and its damping, L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
SCALE = 8.0

_KIND = np.full(256, 3, np.uint8)  # other signs
_KIND[128:] = 1
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, hashes of shapes and the number of tokens before each text."""
    part = data[at[0]:at[-1]]
    kind = _KIND[part]
    edge = at - at[0]
    sign = kind == 3
    change = np.ones(len(part) + 1, bool)
    if len(part):
        change[1:-1] = (sign[1:] != sign[:-1]) | ((kind[1:] == 0) != (kind[:-1] == 0))
        change[edge] = True
    cuts = np.flatnonzero(change)
    starts, ends = cuts[:-1], cuts[1:]
    keep = kind[starts] != 0 if len(part) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    words = hash_spans(lowered(part), starts, ends)
    if len(starts):
        upper = np.concatenate([[0], np.cumsum(_UPPER[part])])
        digit = np.concatenate([[0], np.cumsum(kind == 2)])
        ups, digits, size = upper[ends] - upper[starts], digit[ends] - digit[starts], ends - starts
        shape = (kind[starts].astype(np.int64) * 4 + _UPPER[part[starts]] + 2 * (ups > 1)) * 4 + (digits > 0) + 2 * (digits == size)
        shapes = _mix((shape * 8 + np.minimum(np.log2(size).astype(np.int64), 7)).astype(U) + U(77))
    else:
        shapes = words
    return words, shapes, np.searchsorted(starts, edge)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and value of each feature, in the order of the texts, and the number before each text."""
    words, shapes, before = _tokens(data, at)
    n, texts = len(words), len(at) - 1
    counts = np.diff(before)
    owner = np.repeat(np.arange(texts), counts)
    inner = owner[1:] == owner[:-1] if n else np.zeros(0, bool)
    pairs = _mix(words[:-1] * U(3) + words[1:] * U(5) + U(1)) if n else words
    pairs = np.where(words[:-1] == words[1:], U(0xABCDEF), pairs) if n else pairs
    shaped = _mix(shapes[:-1] * U(7) + shapes[1:] * U(11) + U(2)) if n else words
    share = 1.0 / np.maximum(counts, 1)
    kinds = [(words, owner), (shapes, owner), (pairs[inner], owner[1:][inner]), (shaped[inner], owner[1:][inner])]
    place = np.concatenate([(_mix(h + U(k)) >> U(64 - BITS)).astype(np.int64) for k, (h, _) in enumerate(kinds)])
    text = np.concatenate([o for _, o in kinds])
    order = np.argsort(text, kind="stable")
    return place[order], (SCALE * share)[text[order]], np.searchsorted(text[order], np.arange(texts + 1))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FTRL over the rows of one part; gives its weights and its number of rows. A part has at most
    MAX_TRAIN rows; only their features are kept."""
    rows = []
    for batch in batches:
        at, data = texts_of(batch.column("text"))
        ids, y = batch.column("h").to_numpy(), batch.column("quality").to_numpy()
        for a, b in chunks(at):
            place, value, ahead = features(data, at[a:b + 1])
            for i in range(a, b):
                own = slice(ahead[i - a], ahead[i - a + 1])
                where, back = np.unique(place[own], return_inverse=True)
                rows.append((int(ids[i]), int(y[i]), where.astype(np.int32), np.bincount(back, value[own], len(where)).astype(np.float32)))
    rows.sort(key=lambda r: r[:2])
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias, which isn't penalised

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for _, y, where, value in rows:
            where, value = np.append(where, size), np.append(value, 1.0)
            w = weights(where)
            g = (_sigmoid(w @ value) - y) * value
            s = (np.sqrt(n[where] + g * g) - np.sqrt(n[where])) / ALPHA
            z[where] += g - s * w
            n[where] += g * g
    if rows:
        yield pa.RecordBatch.from_pydict({"rows": pa.array([len(rows)], pa.int64()), "w": pa.array([weights(np.arange(size + 1)).astype("<f4").tobytes()], pa.binary())})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``h, quality, text`` of at most ``max_train`` labels: of several texts of one id the one with the smallest
    hash, so that the bound holds however often an id is repeated."""
    labels, docs = narrow(labels, "doc_id", "quality"), narrow(docs, "doc_id", "text")
    seen = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("h"))
    seen = stage(seen.orderBy("h", "doc_id", "quality").limit(max_train), "quality-labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(seen), "doc_id")  # at most max_train rows of 20 bytes
    one = F.min(F.struct(F.xxhash64("text").alias("k"), "text")).alias("t")
    return rows.groupBy("doc_id", "quality", "h").agg(one).select("h", "quality", "t.text")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights of the 2^BITS places and the bias."""
    rows = training_rows(docs, labels, max_train).repartition(PARTS, F.pmod("h", F.lit(PARTS)))
    parts = rows.mapInArrow(_learn, "rows long, w binary").collect()  # PARTS rows of 4 * 2^BITS bytes
    total = sum(p["rows"] for p in parts)
    w = np.zeros((1 << BITS) + 1)
    for p in sorted(parts, key=lambda p: (p["rows"], bytes(p["w"]))):
        w += np.frombuffer(p["w"], "<f4") * (p["rows"] / total)
    return w.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; it must not have these columns."""
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 4 * 2^BITS bytes
    own = docs.columns
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType(), False)])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            at, data = texts_of(batch.column("text"))
            out = np.full(batch.num_rows, float(w[-1]))
            for a, b in chunks(at):
                place, value, ahead = features(data, at[a:b + 1])
                has = np.flatnonzero(np.diff(ahead))
                if len(has):  # each text's products are summed for themselves, so its score doesn't depend on its neighbours
                    out[a + has] += np.add.reduceat(w[place] * value, ahead[has])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_sigmoid(out))], names=[*own, "score"])

    return docs.mapInArrow(scored, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def judge(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    out = score(narrow(docs, "doc_id", "text"), train(docs, labels, **parameters))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject."""
    plain, back = set_aside(docs, "text")
    return score(plain, train(docs, labels, **parameters)).where("predicted = 1").select(*back)
