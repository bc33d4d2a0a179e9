"""Settle and monitor past predictions (R-5, R-6).

``actual_price`` and ``error`` are declared by the prediction table but never
filled by the reference. Settlement is a left join of the log to the candle that
opens at the prediction horizon (equi-join on symbol and minute: both sides are
partitioned on the same keys, no skew beyond one candle per key).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kandela.session import pin_utc, scratch_path


def settle(predictions: DataFrame, bars: DataFrame, unit: str = "minute") -> DataFrame:
    """Fill ``actual_price`` with the close of the candle opening at
    ``date_trunc(unit, prediction_for)``; ``error = predicted - actual``.
    Unsettled rows keep NULLs. Both columns are there whether or not the log
    has them. Where the candle table has a ``dt`` partition column, the join
    also asks for the day of the horizon, so days without predictions are pruned."""
    pin_utc(predictions.sparkSession)  # minute truncation of UTC wall-clock times
    day = ["_d"] if "dt" in bars.columns else []
    target = bars.select("symbol", F.col("open_time").alias("_t"), F.col("close").alias("_actual"),
                         *([F.col("dt").alias("_d")] if day else []))
    p = predictions.drop("actual_price", "error") \
        .withColumn("_t", F.date_trunc(unit, F.col("prediction_for")).cast("timestamp_ntz"))
    if day:
        p = p.withColumn("_d", F.to_date("_t"))
    out = p.join(target, on=["symbol", "_t", *day], how="left").withColumns(
        {"actual_price": F.col("_actual"), "error": F.col("predicted_price") - F.col("_actual")})
    own = predictions.columns
    return out.select(*own, *[c for c in ("actual_price", "error") if c not in own])


#: Most distinct days whose candles are asked for by literals.
MAX_DAYS = 1000


def settle_log(log: DataFrame, bars: DataFrame, out: str) -> None:
    """Settle the days of the log (partition ``dt``; rows without a time are a day of their own) that
    ``out`` doesn't have finally, and replace just these days.

    A row is ``final`` once it has an actual price, or once there are candles past its horizon (its own is
    missing) or it has no horizon. A day is final when all its rows are and none was added since. Candles are
    read for the days that the horizons of open days fall on, however far they lie ahead."""
    spark = log.sparkSession
    try:
        done = spark.read.parquet(out).groupBy(F.col("dt").alias("_dt")).agg(
            F.count("*").alias("_m"), F.count_if("final").alias("_final")).where("_m = _final")
        counts = log.groupBy("dt").agg(F.count("*").alias("_n"))
        same = F.col("dt").eqNullSafe(F.col("_dt")) & (F.col("_n") == F.col("_m"))
        open_days = counts.join(done, same, "left_anti").select("dt")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        open_days = log.select("dt").distinct()
    days = [r[0] for r in open_days.limit(MAX_DAYS + 1).collect()]
    if not days:
        return
    if len(days) <= MAX_DAYS:
        known = F.col("dt").isin([d for d in days if d is not None])
        log = log.filter(known | F.col("dt").isNull() if None in days else known)
    else:
        log = log.join(open_days.withColumnRenamed("dt", "_dt"), F.col("dt").eqNullSafe(F.col("_dt")), "left_semi")
    newest = bars.agg(F.max("open_time").alias("t"))
    if "dt" in bars.columns:
        last = bars.agg(F.max("dt")).first()[0]  # of the partitions
        newest = bars.filter(F.col("dt") == F.lit(last)).agg(F.max("open_time").alias("t"))
        ends = [r[0] for r in log.select(F.to_date("prediction_for")).distinct().limit(MAX_DAYS + 1).collect()]
        if len(ends) <= MAX_DAYS:
            bars = bars.filter(F.col("dt").isin([d for d in ends if d is not None]))
    past = F.date_trunc("minute", F.col("prediction_for")).cast("timestamp_ntz") < newest.scalar()
    settled = settle(log, bars).withColumn("final", F.col("actual_price").isNotNull() | F.col("prediction_for").isNull() | F.coalesce(past, F.lit(False)))
    stage = scratch_path(spark, "settled")  # it may read what it replaces
    settled.write.parquet(stage)
    spark.read.schema(settled.schema).parquet(stage).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(out)


def monitor_daily(settled: DataFrame) -> DataFrame:
    """R-6: per day and model version: predictions, settled ones, RMSE, MAE."""
    e = F.col("error")
    return (settled.groupBy(F.to_date("timestamp").alias("day"), "model_version")
            .agg(F.count(F.lit(1)).alias("n_predictions"),
                 F.count(e).alias("n_settled"),
                 F.sqrt(F.avg(e * e)).alias("rmse"),
                 F.avg(F.abs(e)).alias("mae")))
