"""Score each micro-batch and append to the prediction log (R-4).

``foreachBatch`` gets a plain DataFrame per micro-batch; it is assembled,
scored with the loaded model and added to the same log, in the same shape, as
the batch job's rows (``plans.scoring.append_predictions``). The log's key
(symbol, time and model version here) makes a replayed micro-batch add nothing.
Rows whose features are NULL or NaN have the status ``invalid``; with
``rejected_dir`` they are written there, one folder for each micro-batch.
"""

from __future__ import annotations

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kandela.plans.model import assemble
from kandela.plans.scoring import append_predictions, prediction_rows
from kandela.schema import FEATURE_COLUMNS, MODEL_VERSION


def score_batch(batch: DataFrame, model: LinearRegressionModel,
                model_version: str = MODEL_VERSION) -> DataFrame:
    """A prediction row, with its status, for every row of the batch."""
    bad = F.lit(False)
    for c in FEATURE_COLUMNS:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    rows = batch.withColumns({
        "request_id": F.xxhash64("symbol", "open_time"), "user_id": F.lit(None).cast("long"),
        "status": F.when(bad, "invalid").otherwise("ok")})
    pred = model.transform(assemble(rows, FEATURE_COLUMNS, handle_invalid="keep"))
    return prediction_rows(pred, F.col("open_time"), F.col("close"), model_version)


def start_scoring(features: DataFrame, model: LinearRegressionModel, log_dir: str,
                  checkpoint: str, available_now: bool = True,
                  processing_time: str = "1 minute", rejected_dir: str | None = None) -> StreamingQuery:
    def sink(batch: DataFrame, batch_id: int) -> None:
        scored = score_batch(batch, model)
        append_predictions(scored, log_dir)
        if rejected_dir:
            scored.filter("status <> 'ok'").write.mode("overwrite").parquet(f"{rejected_dir.rstrip('/')}/batch_id={batch_id}")

    w = features.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
