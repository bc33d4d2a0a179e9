"""Training job end to end (L2, M-8): one lazy plan from candles to a fitted,
evaluated and saved model; spark-submit entry in ``main``.

The training frame, with its time index and train/test cut, is written once as
Parquet in the shared folder of ``spark.checkpoint.dir``: the fit and the
evaluation are plain filters on it, nothing is recomputed, and a lost executor
only costs reading its files again.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

from kandela.operators.features import numeric_columns, refit_features
from kandela.operators.split import indexed, split_indexed
from kandela.plans.model import evaluate, fit_linear, ml_frame, save_model
from kandela.plans.silver import SILVER, build_silver
from kandela.schema import FEATURE_COLUMNS, LABEL
from kandela.session import scratch_path
from kandela.sources.tables import load_bars


@dataclass
class TrainResult:
    model: LinearRegressionModel
    metrics: DataFrame
    predictions: DataFrame
    feature_columns: list


def checked_features(df: DataFrame) -> list[str]:
    """P-8: the model's feature columns in training order. The model is
    positional, so a frame whose numeric columns are not exactly these and the
    label is refused."""
    found = set(numeric_columns(df)) - {LABEL}
    if found != set(FEATURE_COLUMNS):
        raise ValueError(f"feature columns differ: missing {sorted(set(FEATURE_COLUMNS) - found)}, "
                         f"unexpected {sorted(found - set(FEATURE_COLUMNS))}")
    return list(FEATURE_COLUMNS)


def training_frame(silver_df: DataFrame, keys: Sequence[str] = (), refit: bool = False,
                   **kw) -> tuple[DataFrame, list]:
    """(frame with features + label, feature columns). ``refit=True`` is the
    DAG variant that recomputes features on silver (G5)."""
    df = refit_features(silver_df, keys, **kw) if refit else silver_df
    cols = checked_features(df)
    # the DAG's rule: no row with a NULL/NaN feature or label reaches the
    # assembler (silver keeps rows whose taker ratio is NULL on zero volume, G4)
    return df.na.drop(subset=cols + [LABEL]), cols


def run_training(silver_df: DataFrame, keys: Sequence[str] = (), ratio: float = 0.8,
                 embargo: int = 0, refit: bool = False, model_path: str | None = None,
                 materialize: bool = True, **kw) -> TrainResult:
    df, cols = training_frame(silver_df, keys, refit=refit, **kw)
    # one model for all series, so one cut through all of them by time
    frame = indexed(df.select("open_time", *keys, *cols, LABEL), ratio=ratio, ties=keys, ranges=True)
    if materialize:
        path = scratch_path(frame.sparkSession, "training")
        frame.write.parquet(path)
        frame = frame.sparkSession.read.schema(frame.schema).parquet(path)
    train, test = (ml_frame(part, cols, keep=keys) for part in split_indexed(frame, embargo, drop_cols=["open_time"]))
    model = fit_linear(train)
    metrics, preds = evaluate(model, test)
    if model_path:
        save_model(model, model_path)
    return TrainResult(model, metrics, preds, cols)


def main(argv=None) -> None:
    from kandela.operators.bars import bars
    from kandela.session import get_session
    ap = argparse.ArgumentParser(description="Train the candle model")
    ap.add_argument("--events", help="tick parquet (builds candles)")
    ap.add_argument("--silver", help="silver parquet (skip feature build)")
    ap.add_argument("--width", default="1 minute")
    ap.add_argument("--keyed", action="store_true")
    ap.add_argument("--model-path", required=True)
    ap.add_argument("--ratio", type=float, default=0.8)
    ap.add_argument("--embargo", type=int, default=0)
    a = ap.parse_args(argv)
    spark: SparkSession = get_session("kandela-train")
    keys = ["symbol"] if a.keyed else []
    if a.silver:
        silver_df = load_bars(spark, a.silver, SILVER, keys)
    else:
        ev = spark.read.parquet(a.events)
        silver_df = build_silver(bars(ev, a.width, symbol_col="event_type" if a.keyed else None),
                                 keys)
    res = run_training(silver_df, keys, a.ratio, a.embargo, model_path=a.model_path)
    print(json.dumps(res.metrics.first().asDict()))


if __name__ == "__main__":
    main()
