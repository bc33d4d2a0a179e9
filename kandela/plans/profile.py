"""Data-quality profile from mergeable states (A-2, A-4, A-5, A-6, M-10, M-11).

A profile of all history needs no second look at a day: for each (symbol, day) and column the number of rows, NULLs
and NaNs, mean, sum of squared distances from it, least and greatest value and a quantile sketch (KLL) are kept as a table,
which follows what lands in bronze. Profile, quartiles, median and outlier fences of any choice of days and
symbols are merged from these states; a new day reads itself alone.

NULL and NaN are counted and left out of the rest. A column without values has NULL statistics. Numbers, means and
deviations are exact up to rounding; quantiles have a rank within about 3.5 / ``SKETCH`` of the asked one. Whole duplicate rows
can't be told from states (bronze has one row a key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kandela.functions.scalar import iqr_fences
from kandela.plans.silver import _partitions, _read, follow
from kandela.schema import BRONZE
from kandela.sources.sinks import read_bronze

#: Items of a sketch's widest level.
SKETCH = 1024
COLUMNS = [f.name for f in BRONZE.fields if f.dataType.typeName() in ("double", "long", "integer")]
STATES = ("column_name string, row_count long, null_count long, nan_count long, n long, mean double, m2 double, "
          "min double, max double, sketch binary, symbol string, dt date")


def states(df: DataFrame, columns: Sequence[str] = tuple(COLUMNS), by: Sequence[str] = ("symbol", "dt")) -> DataFrame:
    """``by..., column_name`` and its state: one aggregate of ``df`` with partial states on the map side."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        v = F.when(~F.isnan(x), x)
        aggs += [F.count_if(x.isNull()).alias(f"null{i}"), F.count_if(F.isnan(x)).alias(f"nan{i}"), F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"),
                 F.var_pop(v).alias(f"var{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}"),
                 F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias(f"sketch{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"null{i}").alias("null_count"),
                             F.col(f"nan{i}").alias("nan_count"), F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"),
                             (F.col(f"var{i}") * F.col(f"n{i}")).alias("m2"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"),
                             F.col(f"sketch{i}").alias("sketch")))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *aggs).select(*by, F.inline(F.array(*rows)))


def profile(kept: DataFrame, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """``by..., column_name`` with counts, mean, sample deviation, extremes, quartiles, median and Tukey fences, merged
    from states. Distances are taken from the merged mean, not from sums of squares; a mean 10^9 times the deviation leaves
    about 7 digits of it, as a double near the mean has no finer steps."""
    keys = [*by, "column_name"]
    total = kept.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("nan_count").alias("nan_count"),
        F.sum("n").alias("count"), F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch"))
    around = kept.filter("n > 0").join(total.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("mean").alias("_mean")),
                                       [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    spread = around.groupBy(*[F.col(f"_{c}") for c in keys]).agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("_m2"))
    out = total.join(spread, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left")
    at = lambda q: F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    out = out.withColumn("Q1", at(0.25)).withColumn("median", at(0.5)).withColumn("Q3", at(0.75))
    low, high = iqr_fences("Q1", "Q3", k)
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1)))
    return out.select(*keys, "row_count", "null_count", "nan_count", "count", "mean", deviation.alias("stddev"), "min", "max",
                      "Q1", "median", "Q3", low.alias("lower_bound"), high.alias("upper_bound"))


def update_profile(bronze: DataFrame, path: str, touched: DataFrame | None = None, columns: Sequence[str] = tuple(COLUMNS)) -> None:
    """Bring the states at ``path`` up to date after candles landed in the ``touched`` (symbol, dt) partitions of ``bronze``
    (default: all, a first build). Only these partitions are read, and their states replaced."""
    if touched is None or _read(bronze.sparkSession, path, STATES) is None:
        rows = bronze
    elif touched.take(1):
        rows = _partitions(bronze, touched)
    else:
        return
    made = states(rows, columns).repartition("symbol", "dt")
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "dt").parquet(path)


def follow_landing(spark: SparkSession, bronze: str, path: str) -> None:
    """Update the states with what landed in ``bronze`` since the last call."""
    follow(spark, bronze, path, lambda touched: update_profile(read_bronze(spark, bronze), path, touched))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states, one row for each symbol, day and column."""
    return spark.read.schema(STATES).parquet(path)
