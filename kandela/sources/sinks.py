"""Sinks (K-1, K-2, K-5): bronze merge, Parquet round trip, write checks.

Bronze in the reference is one Parquet file replaced on every fetch, so history
is only the last fetch. Here a fetch is merged on (symbol, open_time) into the
(symbol, dt) partitions that it touches: overlapping fetches collapse to one
candle per key, the latest fetch winning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kandela.schema import BRONZE, with_keys
from kandela.session import scratch_path


def merge_bronze(existing: DataFrame, incoming: DataFrame,
                 keys: Sequence[str] = ("symbol", "open_time"),
                 order_col: str = "_fetch", keep_order: bool = False) -> DataFrame:
    """K-1: union two candle sets and keep one row per key, the row with the
    greatest ``order_col`` (fetch time or sequence; ties: the greatest values,
    so the result does not depend on the order of rows or batches). One
    partial-aggregated group-by (``max`` of a struct), so a key fetched many
    times is combined map-side."""
    cols = [c for c in existing.columns if c not in keys and c != order_col]
    a = existing if order_col in existing.columns else existing.withColumn(order_col, F.lit(0))
    b = incoming if order_col in incoming.columns else incoming.withColumn(order_col, F.lit(1))
    u = a.unionByName(b)
    agg = u.groupBy(*keys).agg(F.max(F.struct(order_col, *cols)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols + [order_col] * keep_order])


def write_bronze(df: DataFrame, path: str, keys: Sequence[str] = ("symbol",),
                 mode: str = "append") -> None:
    """Write candles partitioned by key and day (partition pruning on read)."""
    (df.withColumn("dt", F.to_date("open_time"))
       .write.mode(mode).partitionBy(*keys, "dt").parquet(path))


#: Most distinct days or symbols of a fetch that go into the scan as literals.
MAX_LITERALS = 1000


def touched(table: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of ``table`` in the (symbol, dt) partitions that ``incoming`` has
    rows for. The days and symbols are literals of the scan's partition filter
    (a range of days if there are very many), so no other partition is read."""
    days, lo, hi, symbols = incoming.agg(
        F.slice(F.collect_set("dt"), 1, MAX_LITERALS + 1), F.min("dt"), F.max("dt"),
        F.slice(F.collect_set("symbol"), 1, MAX_LITERALS + 1)).first()
    if lo is None:
        return table.limit(0)
    rows = table.filter(F.col("dt").isin(days) if len(days) <= MAX_LITERALS else F.col("dt").between(lo, hi))
    if len(symbols) <= MAX_LITERALS:
        rows = rows.filter(F.col("symbol").isin(symbols))
    return rows.join(incoming.select("symbol", "dt").distinct(), ["symbol", "dt"], "left_semi")


def read_bronze(spark: SparkSession, path: str) -> DataFrame | None:
    """The bronze table with its fixed schema (string symbols, ``fetched_at``
    and ``dt``); None where nothing has landed yet."""
    schema = T.StructType([*with_keys(BRONZE).fields, T.StructField("fetched_at", T.TimestampNTZType()),
                           T.StructField("dt", T.DateType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def land_candles(incoming: DataFrame, path: str) -> None:
    """K-1/R-1: merge fetched candles (``symbol``, bronze columns and
    ``fetched_at``) into the bronze table at ``path``.

    Only the (symbol, dt) partitions that the fetch has rows for are read and
    replaced; in them the candle of the latest fetch wins. The merged rows are
    staged in the shared folder first, so a partition is replaced by rows that
    no longer depend on it. Landing the same fetch again changes nothing, and
    neither does the order of fetches, so backfills and replays are safe.

    A candle without a symbol or a time has no place in the table: it goes to the
    table at ``rejects_path(path)`` (each different one once). The partitions that
    were touched are noted at ``changes_path(path)`` for jobs that follow."""
    spark = incoming.sparkSession
    incoming = incoming.withColumn("dt", F.to_date("open_time")).select(
        *with_keys(BRONZE).names, "fetched_at", "dt")
    stage = scratch_path(spark, "landing")
    incoming.write.parquet(f"{stage}/in")
    incoming = spark.read.schema(incoming.schema).parquet(f"{stage}/in")
    placed = F.col("dt").isNotNull() & (F.coalesce("symbol", F.lit("")) != "")
    _reject(incoming.filter(~placed), rejects_path(path))
    incoming = incoming.filter(placed)
    there = read_bronze(spark, path)
    old = incoming.limit(0) if there is None else touched(there, incoming).select(*incoming.columns)
    merged = merge_bronze(old, incoming, order_col="fetched_at", keep_order=True)
    merged.write.parquet(f"{stage}/out")
    merged = spark.read.schema(merged.schema).parquet(f"{stage}/out")
    (merged.repartition("symbol", "dt").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "dt").parquet(path))
    incoming.select("symbol", "dt").distinct().withColumn("at", F.current_timestamp()).coalesce(1) \
        .write.mode("append").parquet(changes_path(path))


def rejects_path(path: str) -> str:
    """Where landing puts candles without a symbol or a time."""
    return f"{path.rstrip('/')}-rejects"


def changes_path(path: str) -> str:
    """Where landing notes the (symbol, dt) partitions it touched, and when."""
    return f"{path.rstrip('/')}-changes"


def _reject(rows: DataFrame, path: str) -> None:
    rows = rows.drop("dt")
    if not rows.take(1):
        return
    try:
        rows = rows.subtract(rows.sparkSession.read.schema(rows.schema).parquet(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = rows.distinct()
    rows.write.mode("append").parquet(path)


def roundtrip(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """K-2: overwrite-write then read back with the written schema."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    spark: SparkSession = df.sparkSession
    back = spark.read.parquet(path)
    return back.select(*df.columns)


def write_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """K-5: one row: source rows, target rows, and rows of each side missing
    from the other (duplicates count). Both sides go through one group-by of
    whole rows, with +1 and -1 for the side, so one shuffle gives all four."""
    side = lambda df, n, m: df.select(*source.columns, F.lit(n).alias("_s"), F.lit(m).alias("_t"))
    g = (side(source, 1, 0).unionAll(side(target, 0, 1)).groupBy(*source.columns)
         .agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return g.agg(total("_s").alias("source_rows"), total("_t").alias("target_rows"),
                 total(F.greatest(F.col("_s") - F.col("_t"), F.lit(0))).alias("missing_rows"),
                 total(F.greatest(F.col("_t") - F.col("_s"), F.lit(0))).alias("extra_rows"))


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A 64-bit hash of a row in which NULLs count by their place, and 0.0 and -0.0 are equal (as in a group-by)."""
    values = [F.when(F.col(f.name) == 0, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name))
              if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema.fields]
    return F.xxhash64(F.lit(seed), *values, *[F.col(c).isNull() for c in df.columns])


def digests(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n, h1, h2``: number of rows of each group and the sums of two hashes of its rows, whatever their
    order. Sums are made on the map side, so a row for each task and group is shuffled, and none of ``df``."""
    wide = "decimal(28,0)"  # sums of 10^18 rows fit
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[
        F.coalesce(F.sum(_row_hash(df, seed).cast(wide)), F.lit(0).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)])


def compare_digests(source: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., source_rows, target_rows, same``: a row for each group that either side has."""
    side = lambda df, sign: digests(df.select(*source.columns), by).withColumn("_sign", F.lit(sign))
    both = side(source, 1).unionAll(side(target, -1))
    rows = lambda sign: F.coalesce(F.sum(F.when(F.col("_sign") == sign, F.col("n"))), F.lit(0)).cast("bigint")
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & (F.sum(F.col(c) * F.col("_sign")) == 0)
    both = both.withColumn("h1", F.col("h1").cast("decimal(34,0)")).withColumn("h2", F.col("h2").cast("decimal(34,0)"))
    return both.groupBy(*by).agg(rows(1).alias("source_rows"), rows(-1).alias("target_rows"), same.alias("same"))


def check_partitions(source: DataFrame, target: DataFrame, by: Sequence[str] = ("symbol", "dt")) -> DataFrame:
    """K-5 for tables that are too large to shuffle: the result of ``write_check``, but groups (partitions) are
    compared by their digests first, and only the rows of groups that differ are compared one by one.

    Two different groups pass as equal with a chance of about 2^-128 (two sums of 64-bit hashes). Both sides are read
    twice where groups differ, so they should be tables. NULL groups are groups; maps can't be hashed."""
    path = scratch_path(source.sparkSession, "digests")
    found = compare_digests(source, target, by)
    found.write.parquet(path)
    found = source.sparkSession.read.schema(found.schema).parquet(path)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = found.agg(total("source_rows").alias("source_rows"), total("target_rows").alias("target_rows"))
    differ = found.filter(~F.col("same")).select(*[F.col(c).alias(f"_{c}") for c in by])
    if not differ.take(1):
        return counts.withColumn("missing_rows", F.lit(0).cast("bigint")).withColumn("extra_rows", F.lit(0).cast("bigint"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = lambda df: df.select(*source.columns).join(differ, on, "left_semi") if by else df
    rows = write_check(inside(source), inside(target)).select(F.struct("missing_rows", "extra_rows").alias("r")).scalar()
    return counts.withColumn("_r", rows).select("source_rows", "target_rows", F.col("_r.missing_rows"), F.col("_r.extra_rows"))
