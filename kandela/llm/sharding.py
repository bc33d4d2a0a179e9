"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source. A row's fractional rank is
(rank - 1/2) / rows of the source. Sorted by it, every stretch of the table has each source in its
share, so cutting the order into equal counts gives shards that all match the mixture. Shard sizes
differ by one row at most (the law ``rows``).

Both rankings are distributed: rows are ranked inside ranges of the hash (or of the fractional
rank) of about ``RANGE_ROWS`` rows, and the counts of the ranges before are added. So no source,
however large, meets in one task. Identical rows are first counted, then dealt out again under a
running number, which also spreads a row that makes up a third of the table.

A null text has size 8 and the checksum of no bytes (0); null doc_ids and sources are values like
any other (null source: a stratum of its own). An empty table gives no rows. Ties cannot matter:
rows that tie are equal in every returned column. Only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import narrow, nullable_key, repeated, stage, uniform

RANGE_ROWS = 2_000


def _ranks(rows: DataFrame, group: list[str], by: str, ranges: int, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 1) and ``group_rows`` within ``group``, in the order of ``by`` (in [0, 1)) and then ``order``."""
    cut = F.least(F.floor(F.col(by) * ranges), F.lit(ranges - 1)).cast("int")
    rows = rows.withColumn("cut", cut)
    counts = rows.groupBy(*group, "cut").agg(F.count("*").alias("n"))
    w = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = counts.select(*group, "cut", (F.sum("n").over(w.orderBy("cut")) - F.col("n")).alias("before"), F.sum("n").over(w).alias("group_rows"))
    inside = F.row_number().over(W.partitionBy(*group, "cut").orderBy(by, *order))
    return (rows.withColumn("inside", inside).join(before, [*group, "cut"])
            .withColumn("rank", F.col("inside") + F.col("before")).drop("inside", "before", "cut"))


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, source`` of each row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = narrow(docs, "doc_id", "source", "text").select("doc_id", "source", nullable_key(F.col("source")).alias("stratum"),
                       (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    same = stage(rows.groupBy(*rows.columns).agg(F.count("*").alias("m")), "shard-classes")
    rows = repeated(same, "m", "copy").drop("m").withColumn("copy", F.col("copy") + 1)
    rows = stage(rows.withColumn("u", uniform(seed, F.col("doc_id"), F.col("copy"), F.col("text_crc32"))), "shard-rows")
    n = rows.count()
    ranges = max(1, min(100_000, n // RANGE_ROWS))
    ties = ["doc_id", "copy", "size", "text_crc32"]
    ranked = _ranks(rows, ["stratum"], "u", ranges, ties)
    ranked = ranked.withColumn("fraction", (F.col("rank") - F.lit(0.5)) / F.col("group_rows")).drop("rank", "group_rows")
    ranked = _ranks(ranked, [], "fraction", ranges, ["stratum", *ties])
    at = F.col("rank") - 1  # shard s starts at the first place with place * shards >= s * n
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", F.expr(f"cast((rank - 1) * {shards} div {max(n, 1)} as int)"))
            .withColumn("slot", (at - first).cast("bigint"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"))

