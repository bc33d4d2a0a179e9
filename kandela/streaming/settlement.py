"""Settlement and monitoring of predictions as streams (R-5, R-6).

``settle_stream`` joins the stream of predictions with that of candles on symbol and minute of the horizon. Both
sides have a watermark, so Spark keeps a prediction until its candle comes, or until candles so far past it were
seen that it can't come any more: then the prediction is given without an actual price. Each comes out
once, as ``plans.settlement.settle`` has it when all candles are there.

``monitor_stream`` keeps counts and sums of errors for each day and model version and writes the current
figures of the days that a batch touched, replacing the ones before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kandela.session import pin_utc, scratch_path

DELAY = "1 hour"


def settle_stream(predictions: DataFrame, bars: DataFrame, delay: str = DELAY, unit: str = "minute") -> DataFrame:
    """Predictions with ``actual_price`` and ``error``, from streams of predictions and of candles.

    ``delay`` is how late a row of either stream may come, by its horizon or its time. Predictions without
    a horizon or a symbol can't be settled: no candle is theirs, and no watermark passes them, so they are
    left to the batch job."""
    pin_utc(predictions.sparkSession)  # minute truncation of UTC wall-clock times
    own = [c for c in predictions.columns if c not in ("actual_price", "error")]
    p = predictions.select(*own).filter(F.col("prediction_for").isNotNull() & F.col("symbol").isNotNull())
    p = p.withColumn("_due", F.date_trunc(unit, F.col("prediction_for")).cast("timestamp")).withWatermark("_due", delay)
    b = bars.select(F.col("symbol").alias("_symbol"), F.col("open_time").cast("timestamp").alias("_t"), F.col("close").alias("actual_price")).withWatermark("_t", delay)
    # equal times, said as a range too, so that both sides' state is bounded by the watermarks
    on = (F.col("symbol") == F.col("_symbol")) & (F.col("_due") == F.col("_t"))
    out = p.join(b, on, "left_outer")
    names = [*predictions.columns, *[c for c in ("actual_price", "error") if c not in predictions.columns]]
    return out.withColumn("error", F.col("predicted_price") - F.col("actual_price")).select(*names)


def start_settling(predictions: DataFrame, bars: DataFrame, out: str, checkpoint: str, delay: str = DELAY,
                   available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Append settled predictions to a Parquet table (its file sink takes each batch once)."""
    w = settle_stream(predictions, bars, delay).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(out)


MONITOR = "day date, model_version string, n_predictions long, n_settled long, rmse double, mae double"


def day_sums(settled: DataFrame) -> DataFrame:
    """Counts and sums of errors of each day and model version, as a stream's state holds them."""
    e = F.col("error")
    return settled.groupBy(F.to_date("timestamp").alias("day"), "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.count(e).alias("m"), F.sum(e * e).alias("ee"), F.sum(F.abs(e)).alias("ae"))


def start_monitor(settled: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                  processing_time: str = "1 minute") -> StreamingQuery:
    """R-6 as a stream: the table at ``out`` has each day and model version once, with the figures of all settled
    predictions seen so far; a batch replaces the days it touched. A replayed batch writes the same again."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        figures = batch.select("day", "model_version", F.col("n").alias("n_predictions"), F.col("m").alias("n_settled"),
                               F.sqrt(F.try_divide("ee", "m")).alias("rmse"), F.try_divide("ae", "m").alias("mae"))
        stage = scratch_path(spark, "monitor")
        figures.write.parquet(f"{stage}/new")
        new = spark.read.schema(MONITOR).parquet(f"{stage}/new")
        days = new.select(F.col("day").alias("_day"), F.col("model_version").alias("_v")).distinct()
        old = read_monitor(spark, out)
        if old is not None:  # other versions of the same days stay
            same = F.col("day").eqNullSafe(F.col("_day"))
            old = old.join(days.select("_day").distinct(), same, "left_semi").join(days, same & F.col("model_version").eqNullSafe(F.col("_v")), "left_anti")
            new = new.unionByName(old)
        new.write.parquet(f"{stage}/out")
        spark.read.schema(MONITOR).parquet(f"{stage}/out").withColumn("d", F.col("day")).repartition("d").write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(out)

    w = day_sums(settled).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_monitor(spark: SparkSession, path: str) -> DataFrame | None:
    """The monitor's table; None where there is none yet."""
    try:
        return spark.read.schema(f"{MONITOR}, d date").parquet(path).drop("d")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
