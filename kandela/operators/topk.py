"""Top-k, latest rows, ordered preview and history append (T-1 ... T-3, U-1, K-8).

Several rows may have one time (a candle that was fetched twice). They count as one
candle, of which the row with the greatest values is taken, so a result never
hangs on the order of rows and repeats don't use up k.

The k newest times of a table are a ``TakeOrderedAndProject`` over distinct times (each
task keeps k); the per-key form ranks times with ``dense_rank() <= k``, which Spark
plans with a partial ``WindowGroupLimit`` before the shuffle, so a hot key ships
the rows of at most k times per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_k(df: DataFrame, k: int = 10, time_col: str = "open_time",
             ascending_output: bool = True) -> DataFrame:
    """T-1 + T-3: the k newest rows, one for each time, returned in ascending time
    order. Rows without a time are not the newest of anything."""
    times = df.select(F.col(time_col).alias("_t")).where("_t is not null").distinct().orderBy(F.col("_t").desc()).limit(k)
    oldest = times.agg(F.min("_t").alias("_t"))
    top = _one_each(df.where(F.col(time_col) >= oldest.scalar()), [time_col])
    return top.orderBy(time_col) if ascending_output else top.orderBy(F.col(time_col).desc())


def _one_each(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of the rows that agree in ``by``, the one with the greatest other columns."""
    rest = [c for c in df.columns if c not in by]
    if not rest:
        return df.distinct()
    return df.groupBy(*by).agg(F.max(F.struct(*rest)).alias("_r")).select(*[F.col(c) if c in by else F.col(f"_r.{c}").alias(c) for c in df.columns])


def latest_k_per_key(df: DataFrame, keys: Sequence[str], k: int = 10,
                     time_col: str = "open_time", rank_col: str | None = None) -> DataFrame:
    """T-1 per key: the k newest rows of every key, one for each time (rank 1 = newest)."""
    w = Window.partitionBy(*keys).orderBy(F.col(time_col).desc())
    name = rank_col or "_rk"
    out = _one_each(df.withColumn(name, F.dense_rank().over(w)).filter(F.col(name) <= k), [*keys, time_col, name])
    return out if rank_col else out.drop(name)


def latest_row(df: DataFrame, keys: Sequence[str] = (), time_col: str = "open_time") -> DataFrame:
    """T-2: the newest row (per key), via ``max`` of a struct of all columns, time
    first: a declarative aggregate with map-side combine, no sort."""
    rest = [time_col, *[c for c in df.columns if c not in keys and c != time_col]]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in df.columns if c not in keys])


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ("open_time",)) -> DataFrame:
    """K-8: ``show(n)`` made deterministic: first n rows in the given order."""
    return df.orderBy(*order_by).limit(n)


def append_rows(history: DataFrame, new_rows: DataFrame) -> DataFrame:
    """U-1: bag union by column name (plain ``union`` is positional)."""
    return history.unionByName(new_rows, allowMissingColumns=False)
