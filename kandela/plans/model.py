"""Linear model: assemble, fit, score, evaluate, save/load (M-3, M-5 ... M-7, S-5, K-6).

Spark ML does the distributed work (``LinearRegression`` with the normal-equation
solver is one tree-aggregate over the training rows). Metrics are one aggregate
pass, where the reference runs one evaluator job per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kandela.schema import FEATURE_COLUMNS, LABEL

# Parameters of the reference's fitted model (its saved metadata): squared loss,
# no regularisation, intercept, standardisation, auto solver, 100 iterations.
LR_PARAMS = dict(loss="squaredError", regParam=0.0, elasticNetParam=0.0, fitIntercept=True,
                 standardization=True, solver="auto", maxIter=100, tol=1e-6)


def assemble(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS),
             output: str = "features", handle_invalid: str = "error") -> DataFrame:
    """M-3/F-7: add the feature vector. ``handle_invalid="skip"`` drops rows
    with NULL/NaN features; ``"error"`` (default) fails on them."""
    va = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)
    return va.transform(df)


def ml_frame(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS),
             keep: Sequence[str] = ("open_time",), label: str = LABEL,
             handle_invalid: str = "error") -> DataFrame:
    """(keep..., features, label), the reference's ML frame."""
    return assemble(df, columns, handle_invalid=handle_invalid).select(*keep, "features", label)


def flatten_features(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS),
                     vector: str = "features") -> DataFrame:
    """Vector column back to one double column per feature (for checks)."""
    arr = vector_to_array(F.col(vector))
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, *[arr[i].alias(c) for i, c in enumerate(columns)])


def fit_linear(train: DataFrame, features: str = "features", label: str = LABEL,
               **params) -> LinearRegressionModel:
    """M-5: fit the linear regression."""
    p = dict(LR_PARAMS)
    p.update(params)
    return LinearRegression(featuresCol=features, labelCol=label, **p).fit(train)


def score(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """M-6: add ``prediction``."""
    return model.transform(df)


def regression_metrics(pred: DataFrame, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """A-7 ... A-9: n, RMSE, MAE and R^2 in one aggregate pass.
    R^2 = 1 - SSE / (n * var_pop(label)), as the evaluator defines it."""
    e = F.col(prediction) - F.col(label)
    m = pred.agg(F.count(F.lit(1)).alias("n"),
                 F.avg(e * e).alias("_mse"),
                 F.avg(F.abs(e)).alias("mae"),
                 F.var_pop(F.col(label)).alias("_var"))
    return m.select("n", F.sqrt("_mse").alias("rmse"), "mae",
                    (F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"))


def evaluate(model: LinearRegressionModel, test: DataFrame, label: str = LABEL
             ) -> tuple[DataFrame, DataFrame]:
    """M-7: (metrics one-row frame, scored test frame)."""
    pred = score(model, test)
    return regression_metrics(pred, label), pred


def coefficients_frame(spark, model: LinearRegressionModel,
                       columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Fitted coefficients as a small DataFrame (feature, coefficient) plus the
    intercept row."""
    rows = [(c, float(v)) for c, v in zip(columns, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def save_model(model: LinearRegressionModel, path: str) -> None:
    """K-6: overwrite-save."""
    model.write().overwrite().save(path)


def available(spark: SparkSession, path: str) -> bool:
    """S-6: whether there is something at ``path``, in the file system that Spark finds it in (a path
    without a scheme: the cluster's default one, not the driver's disk)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_model(path: str) -> LinearRegressionModel:
    """S-5/S-6: load, refusing clearly when the model is missing."""
    if not available(SparkSession.active(), path):
        raise FileNotFoundError(f"model not available at {path}")
    return LinearRegressionModel.load(path)
