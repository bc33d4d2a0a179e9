"""Data-quality profile and outlier report (A-1 ... A-6, F-2 ... F-5, M-10, M-11).

Where the reference runs one Spark action per statistic and pulls quantiles to
the driver, these are single declarative aggregates returning small DataFrames.
Quantile fences reach the rows as a scalar subquery (one row, computed once),
so no join and no driver round trip is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kandela.functions.scalar import iqr_fences, outside

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A-1: one row, one bigint."""
    return df.agg(F.count(F.lit(1)).alias(name))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A-2/F-5: NULL count of every column in one aggregate, named after the
    column (the reference's layout: one row, one column per input column)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def distinct_profile(df: DataFrame) -> DataFrame:
    """A-3: row count, distinct whole rows and duplicate rows, in one shuffle
    (group by all columns; NULLs compare equal, like ``dropDuplicates``). The
    group-by is partially aggregated before the exchange, so a heavily
    duplicated row never lands whole in one task."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("row_count"),
                 F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_count", F.col("row_count") - F.col("distinct_rows"))


def describe_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A-4: count, mean, sample stddev, min, max per numeric or text column,
    from one aggregate, unpivoted to (column_name, count, mean, stddev, min,
    max, min_text, max_text). Numbers have min and max as doubles; texts have
    them as texts, and no mean (other than ``df.describe()``, which tries to
    read texts as numbers)."""
    kinds = dict(df.dtypes)
    cols = list(columns or [c for c, t in df.dtypes if t in NUMERIC or t == "string"])
    aggs, rows = [], []
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    for i, c in enumerate(cols):
        own = [F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count")]
        if kinds[c] == "string":
            aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            rest = [number, number, number, number, F.col(f"lo{i}"), F.col(f"hi{i}")]
        else:
            x = F.col(c).cast("double")
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                     F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                     F.max(x).alias(f"hi{i}")]
            rest = [F.col(f"m{i}"), F.col(f"s{i}"), F.col(f"lo{i}"), F.col(f"hi{i}"), text, text]
        names = ("mean", "stddev", "min", "max", "min_text", "max_text")
        rows.append(F.struct(*own, *[v.alias(n) for v, n in zip(rest, names)]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def quartiles(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """A-5: approximate Q1 and Q3 (``percentile_approx``), one row."""
    q = F.percentile_approx(F.col(column), [0.25, 0.75], accuracy)
    return df.agg(q.alias("_q")).select(F.col("_q")[0].alias("Q1"), F.col("_q")[1].alias("Q3"))


def iqr_bounds(df: DataFrame, column: str, k: float = 1.5, accuracy: int = 10000) -> DataFrame:
    """A-5/X-6: Q1, Q3, IQR and Tukey fences as one row."""
    lo, hi = iqr_fences("Q1", "Q3", k)
    return quartiles(df, column, accuracy).select(
        "Q1", "Q3", (F.col("Q3") - F.col("Q1")).alias("IQR"),
        lo.alias("lower_bound"), hi.alias("upper_bound"))


def approx_median(df: DataFrame, column: str, relative_error: float = 0.1) -> DataFrame:
    """A-6: median with the given relative rank error (the reference's
    ``approxQuantile(c, [0.5], 0.1)``), kept as a one-row DataFrame."""
    acc = max(1, int(round(1.0 / relative_error)))
    return df.agg(F.percentile_approx(F.col(column), 0.5, acc).alias("median"))


def _fences(df: DataFrame, column: str, k: float, accuracy: int) -> Column:
    """Scalar subquery holding struct(lower_bound, upper_bound)."""
    b = iqr_bounds(df, column, k, accuracy)
    return b.select(F.struct("lower_bound", "upper_bound").alias("f")).scalar()


def flag_outliers(df: DataFrame, column: str, k: float = 1.5, accuracy: int = 10000,
                  flag: str = "is_outlier") -> DataFrame:
    """F-3: flag rows outside the Tukey fences of ``column`` (NULL -> False).
    Nothing is removed (G13)."""
    f = _fences(df, column, k, accuracy)
    return (df.withColumn("_f", f)
              .withColumn(flag, outside(column, F.col("_f.lower_bound"), F.col("_f.upper_bound")))
              .drop("_f"))


def outlier_rows(df: DataFrame, column: str, **kw) -> DataFrame:
    """F-2: only the flagged rows."""
    return flag_outliers(df, column, **kw).filter(F.col("is_outlier"))


def outlier_count(df: DataFrame, column: str, **kw) -> DataFrame:
    """M-10: number of flagged rows, one row."""
    return flag_outliers(df, column, **kw).agg(F.count_if(F.col("is_outlier")).alias("outlier_count"))


def quality_profile(df: DataFrame) -> DataFrame:
    """M-11: one-row data-quality summary: rows, distinct rows, duplicates,
    NULL cells over all columns, rows with any NULL. One scan and one group-by
    of whole rows; NULLs are counted in the distinct rows and weighted by how
    often each occurs."""
    cols = df.columns
    any_null = F.lit(False)
    n_null = F.lit(0)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
        n_null = n_null + F.col(c).isNull().cast("int")
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return g.agg(total("_n").alias("row_count"), F.count(F.lit(1)).alias("distinct_rows"),
                 total(n_null * F.col("_n")).alias("null_cells"),
                 total(F.when(any_null, F.col("_n"))).alias("rows_with_null")) \
        .select("row_count", "distinct_rows", (F.col("row_count") - F.col("distinct_rows")).alias("duplicate_count"),
                "null_cells", "rows_with_null")
