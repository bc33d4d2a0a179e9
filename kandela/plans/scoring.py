"""Set-based scoring of candidate candles (M-9, K-7, S-4, G10).

The reference scores one request at a time: top-10 history, union one row,
global windows, ``first()``. Here n requests are one plan:

1. the newest ``k = 10`` candles of the symbols that occur in the requests, from
   the days that hold them: the candles of each (symbol, day) are counted from
   partition folders and file footers, and the newest days are taken until they
   hold k candles, however far back that is;
2. those candles as one array a symbol (at most k entries), joined to the
   requests on symbol, so a request stays one row;
3. features from the request and its array;
4. assemble, ``transform``, and one row for every request with its status.

Requests never see each other. ``status`` tells what became of a request:

* ``ok``: scored;
* ``stale``: its candle is not newer than the newest candle of its symbol
  (``parity=True`` scores that newest candle instead, as the reference's
  "latest by open_time" does, and calls it ``ok``);
* ``no_history``: no candle of its symbol, or no symbol;
* ``invalid``: a feature is NULL or NaN, or the request has no time.

Only ``ok`` rows have a predicted price.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kandela.functions.scalar import candle_close_time, horizon_time, safe_return, taker_ratio
from kandela.operators.topk import latest_k_per_key
from kandela.plans.model import assemble
from kandela.schema import BAR_COLUMNS, FEATURE_COLUMNS, HORIZON, MODEL_VERSION, PREDICTION, REQUEST
from kandela.session import scratch_path

HISTORY_K = 10
#: Most days and symbols that go into the scan of the history as literals.
MAX_LITERALS = 1000


def requests_frame(spark: SparkSession, rows) -> DataFrame:
    """S-4: inline request rows (tuples, or dicts that may leave fields out; times may be ISO texts) with
    the fixed request schema."""
    names = REQUEST.names

    def value(row, i, f):
        v = row.get(f.name) if isinstance(row, dict) else row[i]
        if isinstance(v, str) and isinstance(f.dataType, T.TimestampNTZType):
            return dt.datetime.fromisoformat(v)
        return float(v) if isinstance(v, int) and isinstance(f.dataType, T.DoubleType) else v

    unknown = {k for row in rows if isinstance(row, dict) for k in row} - set(names)
    if unknown:
        raise ValueError(f"requests have no fields {sorted(unknown)}")
    return spark.createDataFrame([tuple(value(row, i, f) for i, f in enumerate(REQUEST.fields)) for row in rows], REQUEST)


def recent_history(history: DataFrame, requests: DataFrame, k: int = HISTORY_K) -> DataFrame:
    """Step 1: rows of ``history`` that hold the newest k candles of every
    requested symbol. With a ``dt`` partition column, only the days that are
    needed are read; without one, only the symbols are filtered."""
    asked = requests.select("symbol").distinct()
    rows = history.join(asked, "symbol", "left_semi")
    if "dt" not in history.columns:
        return rows
    counts = rows.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy("symbol").orderBy(F.col("dt").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = counts.withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0))).filter(F.col("_newer") < k)
    days = days.select("symbol", "dt")
    path = scratch_path(history.sparkSession, "days")
    days.write.parquet(path)
    days = history.sparkSession.read.schema(days.schema).parquet(path)
    literal = days.agg(F.slice(F.collect_set("dt"), 1, MAX_LITERALS + 1), F.min("dt"),
                       F.slice(F.collect_set("symbol"), 1, MAX_LITERALS + 1)).first()
    rows = history.join(days, ["symbol", "dt"], "left_semi")
    if literal[1] is None:
        return rows.limit(0)
    rows = rows.filter(F.col("dt").isin(literal[0]) if len(literal[0]) <= MAX_LITERALS else F.col("dt") >= F.lit(literal[1]))
    return rows.filter(F.col("symbol").isin(literal[2])) if len(literal[2]) <= MAX_LITERALS else rows


def history_arrays(history: DataFrame, k: int = HISTORY_K) -> DataFrame:
    """Step 2: ``symbol, hist`` with the newest k candles, newest first. Candles
    of the same time are ordered by their other columns."""
    values = [c for c in BAR_COLUMNS if c != "open_time"]
    newest = latest_k_per_key(history.select("symbol", *BAR_COLUMNS), ["symbol"], k)
    return newest.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("open_time", *values)), asc=False).alias("hist"))


def _mean(closes: Column, k: int) -> Column:
    """Mean of the first k closes that are not NULL, oldest added first."""
    own = F.reverse(F.array_compact(F.slice(closes, 1, k)))
    return F.try_divide(F.aggregate(own, F.lit(0.0), lambda s, x: s + x), F.size(own))


def request_features(history: DataFrame, requests: DataFrame, k: int = HISTORY_K,
                     ratio_on_zero: str = "zero", parity: bool = False) -> DataFrame:
    """Steps 1-3: one row for each request with the serving features (guarded
    taker ratio, as the serving path computes it), its ``status``, and whether
    the features are ``complete``. With ``parity`` a stale request's row is the
    newest candle of its symbol."""
    own = F.struct(F.col("requested_at").alias("open_time"), F.col("open_price").alias("open"),
                   F.col("high_price").alias("high"), F.col("low_price").alias("low"), F.col("close_price").alias("close"),
                   "volume", candle_close_time("requested_at", 60).alias("close_time"), "quote_asset_volume",
                   "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")
    req = requests.select("request_id", "symbol", "user_id", "requested_at", F.col("close_price").alias("request_close"), own.alias("own"))
    out = req.join(history_arrays(recent_history(history, requests, k), k), "symbol", "left")
    stale = F.coalesce(~(F.col("requested_at") > F.col("hist")[0]["open_time"]), F.lit(False))
    none = F.col("hist").isNull()
    series = F.concat(F.array("own"), F.coalesce("hist", F.array().cast(out.schema["hist"].dataType)))
    out = out.withColumn("stale", stale).withColumn("none", none)
    out = out.withColumn("series", F.when(stale & F.lit(parity), F.col("hist")).otherwise(series))
    out = out.withColumn("row", F.col("series")[0])
    closes = F.col("series.close")
    out = out.withColumn("_prev", F.get(closes, F.lit(1))).withColumn("MA_5", _mean(closes, 5)).withColumn("MA_10", _mean(closes, 10))
    out = out.select("request_id", "symbol", "user_id", "requested_at", "request_close", "stale", "none", "row.*", "_prev", "MA_5", "MA_10")
    out = out.withColumn("return_1m", safe_return("close", "_prev")).withColumn("taker_ratio", taker_ratio(on_zero=ratio_on_zero))
    bad = F.col("requested_at").isNull()
    for c in FEATURE_COLUMNS:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    status = F.when(F.col("none"), "no_history").when(F.col("stale"), "stale").when(bad, "invalid").otherwise("ok")
    return out.withColumn("status", status).withColumn("complete", ~bad).drop("stale", "none", "_prev")


def score_candidates(history: DataFrame, requests: DataFrame, model: LinearRegressionModel,
                     k: int = HISTORY_K, parity: bool = False,
                     model_version: str = MODEL_VERSION, horizon_minutes: int = HORIZON,
                     features: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """M-9: a prediction row (the ``predictions`` table shape, plus status) for
    every request."""
    feats = request_features(history, requests, k, parity=parity)
    if parity:
        scored = F.when(F.col("status") == "stale", F.when(F.col("complete"), "ok").otherwise("invalid"))
        feats = feats.withColumn("status", F.coalesce(scored, "status"))
    pred = model.transform(assemble(feats, features, handle_invalid="keep"))
    return prediction_rows(pred, F.col("requested_at"), F.col("request_close"), model_version, horizon_minutes)


def prediction_rows(pred: DataFrame, now: Column, price: Column, model_version: str = MODEL_VERSION,
                    horizon_minutes: int = HORIZON) -> DataFrame:
    """Scored rows (``request_id, user_id, symbol, prediction, status``) in the shape of the log."""
    number = F.lit(None).cast("double")
    return pred.select(
        "request_id", F.col("user_id").cast("long").alias("user_id"), "symbol",
        now.alias("timestamp"), horizon_time(now, horizon_minutes).alias("prediction_for"),
        price.alias("current_price"),
        F.when(F.col("status") == "ok", F.col("prediction")).alias("predicted_price"),
        number.alias("actual_price"), number.alias("confidence_lower"), number.alias("confidence_upper"),
        F.lit(model_version).alias("model_version"), number.alias("error"),
        F.localtimestamp().alias("created_at"), F.localtimestamp().alias("updated_at"), "status")


#: What makes a prediction one of a kind; null users and symbols are values of their own.
LOG_KEY = ["user_id", "symbol", "timestamp", "model_version"]


def append_predictions(pred: DataFrame, path: str) -> None:
    """K-7: add the scored rows (status ``ok``) to the log (Parquet, partitioned
    by day).

    A row whose key (user, symbol, time, model version) the log has already is
    not added again, and of rows of one key in ``pred`` the one with the
    smallest request id is. Only the days of the new rows are read. So running
    a batch again after a failure adds what is missing and nothing twice; one
    writer at a time is assumed, as Spark's file output gives no locks."""
    spark = pred.sparkSession
    cols = [f.name for f in PREDICTION.fields]
    if "status" in pred.columns:
        pred = pred.filter("status = 'ok'")
    first = F.min_by(F.struct(*[c for c in cols if c not in LOG_KEY]), F.struct("request_id", "current_price", "predicted_price"))
    new = pred.groupBy(*LOG_KEY).agg(first.alias("_r")).select(*LOG_KEY, "_r.*").select(*cols)
    new = new.withColumn("dt", F.to_date("timestamp"))
    stage = scratch_path(spark, "predictions")  # created_at is taken once
    new.write.parquet(stage)
    new = spark.read.schema(new.schema).parquet(stage)
    days = [r[0] for r in new.select("dt").distinct().limit(MAX_LITERALS + 1).collect()]
    try:
        log = read_predictions(spark, path)
        if len(days) <= MAX_LITERALS:  # a row without a time has no day
            known = F.col("dt").isin([d for d in days if d is not None])
            log = log.filter(known | F.col("dt").isNull() if None in days else known)
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"l.{c}")) for c in [*LOG_KEY, "dt"]]
        on = same[0]
        for s in same[1:]:
            on = on & s
        new = new.alias("n").join(log.alias("l"), on, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new.write.mode("append").partitionBy("dt").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The prediction log with its fixed schema (an empty log reads as empty)."""
    schema = T.StructType(list(PREDICTION.fields) + [T.StructField("dt", T.DateType())])
    return spark.read.schema(schema).parquet(path)
