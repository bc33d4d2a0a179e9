"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit for each component: 1 where it is above 0. The code is cut into about
bits / log2(codes) segments, and every code is listed under the value of each of its segments. A query
looks up the values that differ from its own segment in r bits, for r = 0, 1, 2 and so on. Once radius
r - 1 is done in all segments, a code not seen differs in at least r bits in each of them; and once
radius r is done in m of the segments, its distance is at least segments * r + m. So a query whose k-th
verified distance D is known needs radius r in ``D - segments * r + 1`` segments only, and ends when
that is none: all codes at distance D or less have been compared, ties included. The values of a
segment are about as many as the codes, so even a query that has to try all of them does not do more
look-ups than a full comparison.

The values are made in the tasks, ``MASKS_A_ROW`` at a time from their ranks; the driver only counts them.

A pair may meet in several segments; it is kept at the smallest radius and the first segment in which
it meets, which is seen from the pair itself, so no pairs are shuffled to drop repeats. Equal codes are
one entry with its k + 1 smallest ids (more can never be among the nearest, as ties go to the smaller
id), and equal queries are searched once. So groups of copies cost no more than one row.

A vector that is null, empty or whose components are all null has no code: it is neither found nor
answered. Null and NaN components count as 0, missing ones of shorter vectors too. Rows without an
id are left out, repeated rows count once. With fewer than k other vectors, all are returned. The
query's own row is never among its results. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, stage

TOP, EVERY = 10, 50
#: Widest segment, so that its values fit a non-negative int.
MAX_WIDTH = 30
MASKS_A_ROW = 4096
#: Look-ups that a task makes, and most tasks of a radius.
LOOKUPS_A_TASK, MAX_TASKS = 1 << 20, 20_000


def segment_widths(bits: int, codes: int) -> list[int]:
    """Widths of the segments: about log2(codes) bits each, as even as possible."""
    want = min(MAX_WIDTH, max(4, math.log2(max(2, codes))))
    n = max(1, math.ceil(bits / MAX_WIDTH), round(bits / want))
    return [bits // n + (i < bits % n) for i in range(n)]


def _segments(widths: list[int]):
    bits = sum(widths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float)
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
            ones = np.zeros((len(size), bits), np.int64)
            ones[row, at] = np.nan_to_num(values, nan=0.0) > 0
            cols, a = [], 0
            for w in widths:
                cols.append(pa.array((ones[:, a:a + w] << np.arange(w)).sum(axis=1).astype(np.int32)))
                a += w
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols], names=["id", *(f"s{i}" for i in range(len(widths)))])
    return run


def top_k(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = TOP, is_query: Column | None = None) -> DataFrame:
    """``query_id, rank, <id>, distance``: for each query the k other vectors of smallest Hamming distance, ties by id."""
    query = F.pmod(F.col("id"), F.lit(EVERY)) == 0 if is_query is None else is_query
    rows = narrow(vectors, id_column, vector_column).toDF("id", "v").where(
        F.col("id").isNotNull() & F.exists("v", lambda x: x.isNotNull()))
    bits, n = rows.agg(F.max(F.size("v")), F.approx_count_distinct("v")).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_column), F.lit(0).alias("distance")).limit(0)
    widths = segment_widths(bits, n)
    s = [f"s{i}" for i in range(len(widths))]
    kind = rows.schema["id"].dataType.simpleString()
    rows = stage(rows.mapInArrow(_segments(widths), f"id {kind}, " + ", ".join(f"{c} int" for c in s)).distinct(), "codes")
    nearest = rows.withColumn("i", F.row_number().over(W.partitionBy(*s).orderBy("id"))).where(F.col("i") <= k + 1)
    codes = stage(nearest.groupBy(*s).agg(F.array_sort(F.collect_list("id")).alias("ids")), "code-ids")
    index = stage(codes.select("ids", *s, F.posexplode(F.array(*s)).alias("j", "value")), "code-index")
    asked = rows.where(query).select(F.col("id").alias("query_id"), *s)
    # a query code is named by its own segments; ``far`` is the distance of its (k + 1)-th entry so far
    queries = stage(asked.select(*[F.col(c).alias(f"q{c}") for c in s]).distinct(), "queries")
    q = [f"q{c}" for c in s]
    best, active = None, queries.withColumn("far", F.lit(None).cast("int"))
    for r in range(max(widths) + 1):
        parts = F.when(F.col("far").isNull(), len(widths)).otherwise(F.least(F.col("far") - len(widths) * r + 1, F.lit(len(widths))))
        active = stage(active.withColumn("parts", parts).where("parts > 0"), "active")
        left = active.count()
        if not left:
            break
        rows_of = [math.ceil(math.comb(w, r) / MASKS_A_ROW) for w in widths]
        probes = active.select("*", F.posexplode(F.array(*q)).alias("j", "own")).where("j < parts")
        probes = probes.withColumn("n", F.array(*map(F.lit, rows_of))[F.col("j")]).where("n > 0")  # none where r is above the width
        probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("parts", "n")
        tasks = min(MAX_TASKS, math.ceil(left * sum(math.comb(w, r) for w in widths) / LOOKUPS_A_TASK))
        probes = probes.repartition(tasks, *q, "j", "part").mapInArrow(_values(widths, r), ", ".join(f"{c} int" for c in [*q, "far", "j", "value"]))
        apart = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(s, q, strict=True)]
        earlier = F.lit(False)  # met at a smaller radius, or at this one in a segment before
        for i, d in enumerate(apart):
            earlier = earlier | (d < r) | ((F.col("j") > i) & (d == r))
        distance = sum(apart[1:], apart[0]).cast("int")
        # merged: what mapInArrow gives is estimated far too small to be broadcast
        met = probes.join(index.hint("merge"), ["j", "value"]).where(~earlier).withColumn("distance", distance).where(F.col("far").isNull() | (F.col("distance") <= F.col("far")))
        met = met.select(*q, "distance", F.explode("ids").alias("id"))
        met = met if best is None else met.unionAll(best)
        best = stage(met.withColumn("i", F.row_number().over(W.partitionBy(*q).orderBy("distance", "id"))).where(F.col("i") <= k + 1).drop("i"), "best")
        far = best.groupBy(*q).agg(F.when(F.count("*") > k, F.max("distance")).alias("far"))
        active = active.select(*q).join(far, q, "left")
    out = asked.join(best, [F.col(a) == F.col(b) for a, b in zip(s, q, strict=True)]).where("id <> query_id")
    out = out.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias(id_column), "distance")


def masks(width: int, r: int, first: int, end: int) -> np.ndarray:
    """Of the sets of ``r`` of ``width`` bits, in ascending order as numbers, those from ``first`` to before ``end``."""
    rank = np.arange(first, min(end, math.comb(width, r)), dtype=np.int64)
    out = np.zeros(len(rank), np.int64)
    for i in range(r, 0, -1):
        below = np.array([math.comb(c, i) for c in range(width)], np.int64)  # sets whose highest bit is under c
        top = np.searchsorted(below, rank, side="right") - 1
        out |= 1 << top
        rank -= below[top]
    return out


def _values(widths: list[int], r: int):
    """The values that each probe (segment ``j``, part ``part`` of its masks) looks up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [c for c in batch.schema.names if c not in ("own", "part")]
            j, part, own = (batch.column(c).to_numpy() for c in ("j", "part", "own"))
            width = np.asarray(widths)[j]
            for w, p in np.unique(np.stack([width, part], axis=1), axis=0).tolist():
                m = masks(w, r, p * MASKS_A_ROW, (p + 1) * MASKS_A_ROW)
                alike = np.flatnonzero((width == w) & (part == p))
                few = max(1, 16 * MASKS_A_ROW // max(1, len(m)))
                for at in (alike[i:i + few] for i in range(0, len(alike), few)):
                    row = pa.array(np.repeat(at, len(m)))
                    value = (own[at][:, None] ^ m).ravel().astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in keep), pa.array(value)], names=[*keep, "value"])
    return run
