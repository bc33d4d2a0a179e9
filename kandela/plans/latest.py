"""The newest candles of each symbol as a maintained table (M-9, T-1).

Scoring needs ten candles of a symbol. Looking for them in the history costs a count of all (symbol, day) partitions
for every batch of requests. Here they are a table of their own, at most k rows for each symbol, which follows what
lands in bronze: only touched partitions are read, and of them only days that can hold one of a symbol's newest k.

The table is partitioned by a hash of the symbol, so an update rewrites the parts whose symbols changed. Landing
adds candles and replaces them, but takes none away; after a deletion the table is built anew (``touched=None``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kandela.operators.topk import latest_k_per_key
from kandela.plans.scoring import HISTORY_K
from kandela.plans.silver import _kept, _partitions, _read, follow
from kandela.schema import BRONZE, with_keys
from kandela.sources.sinks import read_bronze

#: Parts of the table: symbols of one part are rewritten together.
PARTS = 64
LATEST = T.StructType([*with_keys(BRONZE).fields, T.StructField("part", T.IntegerType())])


def _part(symbol: str) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(PARTS)).cast("int")


def update_latest(bronze: DataFrame, path: str, touched: DataFrame | None = None, k: int = HISTORY_K) -> DataFrame:
    """Bring the table at ``path`` up to date after candles landed in the ``touched`` (symbol, dt) partitions of
    ``bronze`` (default: all, a first build); gives the partitions that had to be read.

    Any number of updates, in any order of days, leaves the newest k candles that the whole history has. Symbols and
    days are not null (landing sees to that); k is the same for all updates of a table."""
    spark = bronze.sparkSession
    columns = with_keys(BRONZE).names
    old = _read(spark, path, LATEST)
    if touched is None or old is None:
        needed = _kept(bronze.select("symbol", "dt").distinct(), "needed")
        rows = bronze.select(*columns)
        others = None
    else:
        old = old.withColumn("dt", F.to_date("open_time"))
        oldest = old.groupBy("symbol").agg(F.min("dt").alias("oldest"), F.count("*").alias("n"))
        can = F.col("n").isNull() | (F.col("n") < k) | (F.col("dt") >= F.col("oldest"))
        needed = _kept(touched.distinct().join(oldest, "symbol", "left").filter(can).select("symbol", "dt"), "needed")
        parts = [r[0] for r in needed.select(_part("symbol")).distinct().collect()]  # at most PARTS
        if not parts:
            return needed
        old = old.filter(F.col("part").isin(parts))
        symbols = needed.select("symbol").distinct()
        others = old.join(symbols, "symbol", "left_anti").select(*columns)
        own = old.join(symbols, "symbol", "left_semi").join(needed, ["symbol", "dt"], "left_anti").select(*columns)
        rows = _partitions(bronze, needed).select(*columns).unionByName(own)
    new = latest_k_per_key(rows, ["symbol"], k).select(*columns)
    new = _kept(new if others is None else new.unionByName(others), "latest").withColumn("part", _part("symbol"))
    new.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return needed


def follow_landing(spark: SparkSession, bronze: str, latest: str, k: int = HISTORY_K) -> DataFrame | None:
    """Update the table with what landed in ``bronze`` since the last call (None: nothing did)."""
    return follow(spark, bronze, latest, lambda touched: update_latest(read_bronze(spark, bronze), latest, touched, k))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table as a history for scoring (``symbol`` and the candle's columns)."""
    return spark.read.schema(LATEST).parquet(path).drop("part")
