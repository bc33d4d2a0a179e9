"""Least squares from mergeable day sums (M-5, M-8).

A linear fit needs no rows, only their number and the sums of all products of two variables. These are kept as a
table of days, so a daily refit reads one new day of silver and the sums of the others, where the reference fits
on the whole history again each day. Sums of days are merged by adding them.

Prices are large and alike, and sums of raw products would lose the digits that matter. So variables are first
shifted and scaled by fixed numbers (``Scale``, measured once on the first days and stored beside the sums).
The normal equations are then solved for the centred variables and turned back to coefficients of the raw ones.

Rows with a NULL or NaN in a variable are left out, as by the training job. A day without rows has no sums. With
fewer rows than variables, or variables that depend on each other, the shortest solution is taken.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kandela.schema import FEATURE_COLUMNS, LABEL
from kandela.session import scratch_path

VARIABLES = [*FEATURE_COLUMNS, LABEL]


@dataclass(frozen=True)
class Scale:
    """What is taken off each variable, and what it is divided by then."""

    shift: tuple[float, ...]
    by: tuple[float, ...]

    @classmethod
    def of(cls, df: DataFrame, variables: Sequence[str] = tuple(VARIABLES)) -> Scale:
        """Means and standard deviations of ``df``: one aggregate, one row."""
        row = usable(df, variables).agg(*[F.avg(c) for c in variables], *[F.stddev_pop(c) for c in variables]).first()
        k = len(variables)
        return cls(tuple(float(v or 0.0) for v in row[:k]), tuple(float(v or 1.0) for v in row[k:]))


def usable(df: DataFrame, variables: Sequence[str] = tuple(VARIABLES)) -> DataFrame:
    return df.na.drop(subset=list(variables))


def pairs(k: int) -> list[tuple[int, int]]:
    """Pairs of variables that have a product; the last, ``k``, is the constant 1."""
    return [(i, j) for i in range(k + 1) for j in range(i, k + 1)]


def moments(df: DataFrame, scale: Scale, by: Sequence[str] = (), variables: Sequence[str] = tuple(VARIABLES)) -> DataFrame:
    """``by..., m``: for each group the sums of products of two scaled variables, in the order of ``pairs``. One
    aggregate with partial sums on the map side, of as many rows as there are groups."""
    z = [(F.col(c).cast("double") - F.lit(s)) / F.lit(b) for c, s, b in zip(variables, scale.shift, scale.by, strict=True)]
    z.append(F.lit(1.0))
    sums = [F.sum(z[i] * z[j]) for i, j in pairs(len(variables))]
    return usable(df, variables).groupBy(*by).agg(F.array(*sums).alias("m"))


def merged(sums: DataFrame, by: Sequence[str] = (), variables: Sequence[str] = tuple(VARIABLES)) -> DataFrame:
    """Sums of groups added up."""
    return sums.groupBy(*by).agg(F.array(*[F.sum(F.col("m")[i]) for i in range(len(pairs(len(variables))))]).alias("m"))


def table(sums: DataFrame, variables: Sequence[str] = tuple(VARIABLES)) -> DataFrame:
    """Merged sums as rows: names of the two variables (``one`` for the constant) and ``value``."""
    names = [*variables, "one"]
    rows = F.array(*[F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b"), F.col("m")[p].alias("value")) for p, (i, j) in enumerate(pairs(len(variables)))])
    return merged(sums, (), variables).select(F.inline(rows))


def solve(m: Sequence[float], scale: Scale) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from merged sums; the last variable is the label."""
    k = len(scale.shift)
    g = np.zeros((k + 1, k + 1))
    for (i, j), v in zip(pairs(k), m, strict=True):
        g[i, j] = g[j, i] = v
    n, total = g[k, k], g[:k, k]
    mean = total / n
    cov = g[:k, :k] - np.outer(total, mean)  # about the mean of all rows
    spread = np.sqrt(np.maximum(np.diag(cov), 0.0))
    spread[spread == 0] = 1.0
    corr = cov / np.outer(spread, spread)
    w = np.linalg.lstsq(corr[:-1, :-1], corr[:-1, -1], rcond=1e-13)[0] * spread[-1] / spread[:-1]
    shift, by = np.array(scale.shift), np.array(scale.by)
    w = w * by[-1] / by[:-1]
    at = shift + mean * by  # means of the raw variables
    return w, float(at[-1] - w @ at[:-1])


def fit(sums: DataFrame, scale: Scale, variables: Sequence[str] = tuple(VARIABLES)) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of all rows that are in ``sums``."""
    row = merged(sums, (), variables).first()  # one row
    if row is None or row["m"][-1] is None:
        raise ValueError("there are no rows to fit")
    return solve(row["m"], scale)


def to_model(spark: SparkSession, coefficients: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A model that scores, is saved and is loaded like a fitted one."""
    from pyspark.ml.common import _py2java
    vector = _py2java(spark.sparkContext, Vectors.dense([float(v) for v in coefficients]))
    java = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel("linReg_moments", vector, float(intercept))
    java.set(java.labelCol(), LABEL)
    return LinearRegressionModel(java)


def update(silver: DataFrame, path: str, days: DataFrame | None = None) -> None:
    """Bring the table of day sums at ``path`` up to date with ``silver`` (which has a ``dt`` column): for the
    ``days`` given (a ``dt`` column; default: those that it lacks) the sums are made anew, from these days' rows
    only. The scale is measured at the first call."""
    spark = silver.sparkSession
    there = read(spark, path)
    if days is None:
        days = silver.select("dt").distinct() if there is None else silver.select("dt").distinct().join(there.select("dt"), "dt", "left_anti")
    wanted = [r[0] for r in days.distinct().collect()]  # days, not rows
    if not wanted:
        return
    rows = silver.filter(F.col("dt").isin(wanted))
    if there is None:
        scale = Scale.of(rows)
        spark.createDataFrame([(json.dumps([scale.shift, scale.by]),)], "scale string").coalesce(1).write.parquet(f"{path}/scale")
    new = moments(rows, read_scale(spark, path), ["dt"])
    stage = scratch_path(spark, "moments")
    new.write.parquet(stage)
    spark.read.schema(new.schema).parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{path}/days")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """``m, dt`` of each day; None where there is no table."""
    try:
        return spark.read.schema("m array<double>, dt date").parquet(f"{path}/days")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_scale(spark: SparkSession, path: str) -> Scale:
    shift, by = json.loads(spark.read.parquet(f"{path}/scale").first()[0])
    return Scale(tuple(shift), tuple(by))


def refit(spark: SparkSession, path: str, until=None) -> LinearRegressionModel:
    """The model of all days of the table, or of those before ``until`` (a date), from their sums alone."""
    sums = read(spark, path)
    if sums is None:
        raise ValueError(f"there are no day sums at {path}")
    return to_model(spark, *fit(sums if until is None else sums.filter(F.col("dt") < F.lit(until)), read_scale(spark, path)))
