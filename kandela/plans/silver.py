"""Bronze -> silver job (L1, M-1), its stage writer (K-2), and its incremental form.

A candle's silver row hangs on the nine candles before it and the ten after it. So when candles land in a day, only
rows near that day change, and a daily job need not build all history again, as the reference does:
``update_silver`` rebuilds the (symbol, dt) partitions that were touched and those next to them which reach into
them, from the candles of these partitions and their neighbours. How far that is, in days, is read from a
small table of row counts (one row for each symbol and day).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kandela.operators.features import silver
from kandela.schema import BRONZE, DERIVED_COLUMNS, HORIZON
from kandela.session import scratch_path
from kandela.sources.sinks import MAX_LITERALS, changes_path, read_bronze

#: Silver: the candle columns, the label and the derived features.
SILVER = T.StructType([*BRONZE.fields, *(T.StructField(c, T.DoubleType()) for c in DERIVED_COLUMNS)])


def build_silver(bronze: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """Features + label + null drop, one lazy plan."""
    return silver(bronze, keys, **kw)


def write_silver(df: DataFrame, path: str, keys: Sequence[str] = (),
                 partition_by_day: bool = True, mode: str = "overwrite") -> None:
    """Write silver partitioned by key and day (no ``coalesce(1)``: AQE sizes
    the output files). Readers then prune partitions on ``symbol``/``dt``."""
    parts = list(keys)
    if partition_by_day:
        df = df.withColumn("dt", F.to_date("open_time"))
        parts.append("dt")
    w = df.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


#: Candles before and after a candle that its silver row hangs on.
BACK, AHEAD = 9, HORIZON


def counts_path(silver: str) -> str:
    """Where the numbers of candles of each (symbol, dt) are kept."""
    return f"{silver.rstrip('/')}-counts"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _near(days: DataFrame, mark: str, behind: int, ahead: int) -> DataFrame:
    """``days`` (``symbol, dt, start, end``: candles before the day, and up to its end) that hold one of the
    ``behind`` candles before a day with ``mark`` or of the ``ahead`` candles after it, or have it themselves."""
    by = Window.partitionBy("symbol").orderBy("dt")
    later = Window.partitionBy("symbol").orderBy(F.desc("dt"))
    next_start = F.min(F.when(F.col(mark), F.col("start"))).over(later)
    last_end = F.max(F.when(F.col(mark), F.col("end"))).over(by)
    close = (next_start - F.col("end") < behind) | (F.col("start") - last_end < ahead)
    days = days.withColumn("_near", F.col(mark) | F.coalesce(close, F.lit(False)))
    return days.filter("_near").drop("_near")


def _partitions(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the ``wanted`` (symbol, dt) partitions; days and symbols are literals of the scan."""
    days, lo, hi, symbols = wanted.agg(F.slice(F.collect_set("dt"), 1, MAX_LITERALS + 1), F.min("dt"), F.max("dt"),
                                       F.slice(F.collect_set("symbol"), 1, MAX_LITERALS + 1)).first()
    rows = table.filter(F.col("dt").isin(days) if len(days) <= MAX_LITERALS else F.col("dt").between(lo, hi))
    if len(symbols) <= MAX_LITERALS:
        rows = rows.filter(F.col("symbol").isin(symbols))
    return rows.join(wanted.select("symbol", "dt"), ["symbol", "dt"], "left_semi")


def update_silver(bronze: DataFrame, path: str, touched: DataFrame | None = None, **kw) -> DataFrame:
    """Bring the silver table at ``path`` up to date after candles landed in the ``touched`` (symbol, dt) partitions of
    ``bronze`` (default: all, a first build); gives the partitions that were rebuilt.

    Any number of updates, in any order of days, leaves the table that one full build makes. Only the
    touched partitions and their neighbours are read. Symbols and days are not null (landing sees to that)."""
    spark = bronze.sparkSession
    counts = _read(spark, counts_path(path), "n long, symbol string, dt date")
    whole = touched is None or counts is None
    new = bronze if whole else _partitions(bronze, touched)
    new = _kept(new.groupBy("symbol", "dt").agg(F.count("*").alias("n")), "counts")
    if not new.take(1):
        return new.select("symbol", "dt")
    all_ = new.withColumn("touched", F.lit(True))
    if not whole:
        old = counts.join(new.select("symbol", "dt"), ["symbol", "dt"], "left_anti").join(new.select("symbol").distinct(), "symbol", "left_semi")
        all_ = all_.unionByName(old.withColumn("touched", F.lit(False)))
    end = F.sum("n").over(Window.partitionBy("symbol").orderBy("dt"))
    days = _kept(all_.select("symbol", "dt", "touched", (end - F.col("n")).alias("start"), end.alias("end")), "days")
    rebuilt = _kept(_near(days, "touched", AHEAD, BACK).select("symbol", "dt"), "rebuilt")
    marked = days.join(rebuilt.withColumn("_r", F.lit(True)), ["symbol", "dt"], "left").withColumn("rebuilt", F.col("_r").isNotNull())
    needed = _kept(_near(marked, "rebuilt", BACK, AHEAD).select("symbol", "dt"), "needed")
    rows = _partitions(bronze, needed).select("symbol", *BRONZE.names)
    made = build_silver(rows, ["symbol"], **kw).withColumn("dt", F.to_date("open_time")).join(rebuilt, ["symbol", "dt"], "left_semi")
    made = _kept(made, "silver")
    for df, to in ((made, path), (new.select("n", "symbol", "dt"), counts_path(path))):
        df.repartition("symbol", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "dt").parquet(to)
    return rebuilt


def follow(spark: SparkSession, bronze: str, table: str, update: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """``update(touched)`` for the (symbol, dt) partitions that landed in ``bronze`` since the last call for ``table``
    (None: nothing did). What was done is noted beside the table after it is written, so a call that failed is
    simply made again."""
    changes = _read(spark, changes_path(bronze), "symbol string, dt date, at timestamp")
    if changes is None:
        return None
    done = _read(spark, f"{table.rstrip('/')}-done", "until timestamp")
    until = None if done is None else done.agg(F.max("until")).first()[0]
    new = changes if until is None else changes.filter(F.col("at") > F.lit(until))
    newest = new.agg(F.max("at")).first()[0]
    if newest is None:
        return None
    out = update(new.filter(F.col("at") <= F.lit(newest)).select("symbol", "dt").distinct())
    spark.createDataFrame([(newest,)], "until timestamp").coalesce(1).write.mode("append").parquet(f"{table.rstrip('/')}-done")
    return out


def follow_landing(spark: SparkSession, bronze: str, silver: str, **kw) -> DataFrame | None:
    """Update silver with what landed in ``bronze`` since the last call (None: nothing did)."""
    return follow(spark, bronze, silver, lambda touched: update_silver(read_bronze(spark, bronze), silver, touched, **kw))
