"""Candle-shaped inputs derived from the driver tables (FIXTURES.md).

The driver ships ticks (``events``), not candles; these lazy frames turn them
into the shapes the reference reads, so every query's work grows with the
driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kandela.operators.bars import bars
from kandela.sources.tables import table

HOUR = "1 hour"
MINUTE = "1 minute"
# time bucket per candle width for the one-exchange ("edges") windows: each
# bucket must hold many more than back + fwd = 19 candles
BUCKET = {HOUR: "month", MINUTE: "day"}


def edges(width: str) -> dict:
    """Window-method arguments for candles of ``width``."""
    return {"method": "edges", "bucket_unit": BUCKET[width]}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def bronze(spark: SparkSession, sf_dir: str, width: str = HOUR, keyed: bool = False) -> DataFrame:
    """All events as one series (``keyed=False``) or one series per
    ``event_type`` as ``symbol`` (``keyed=True``)."""
    return bars(events(spark, sf_dir), width=width,
                symbol_col="event_type" if keyed else None)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users`` dimension from ``customer``: id, username, email, created_at."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"))


def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users left after a delete list (accounts with a negative balance are
    deleted): the side against which orphans are found."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"))


def refetched(spark: SparkSession, sf_dir: str, width: str = MINUTE) -> DataFrame:
    """Two overlapping fetches of the same candles (every candle twice), the
    situation minute-rate fetches of 600 candles produce."""
    b = bronze(spark, sf_dir, width, keyed=True)
    return b.unionByName(b)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log fixture: every keyed minute candle is a request; the
    prediction is MA_5, the horizon ten minutes; user_id cycles over all
    customers with the candle's epoch minute."""
    from kandela.functions.scalar import horizon_time
    from kandela.operators.features import add_features
    n_users = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    f = add_features(bronze(spark, sf_dir, MINUTE, keyed=True), keys=["symbol"], **edges(MINUTE))
    t = F.col("open_time")
    minute = F.expr("unix_timestamp(open_time) div 60")
    return f.select(
        ((minute % n_users) + 1).alias("user_id"),
        "symbol",
        t.alias("timestamp"),
        horizon_time(t, 10).alias("prediction_for"),
        F.col("close").alias("current_price"),
        F.col("MA_5").alias("predicted_price"),
        F.lit(None).cast("double").alias("actual_price"),
        F.lit("v1.0.0").alias("model_version"),
        F.lit(None).cast("double").alias("error"))


def requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(history, requests): the newest keyed minute candle of each symbol is a
    scoring request; history is every other candle."""
    from kandela.operators.topk import latest_row
    b = bronze(spark, sf_dir, MINUTE, keyed=True)
    newest = latest_row(b, ["symbol"])
    n_users = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    req = newest.select(
        F.xxhash64("symbol", "open_time").alias("request_id"), "symbol",
        ((F.col("number_of_trades") % n_users) + 1).alias("user_id"),
        F.col("open_time").alias("requested_at"),
        F.col("open").alias("open_price"), F.col("high").alias("high_price"),
        F.col("low").alias("low_price"), F.col("close").alias("close_price"),
        "volume", "quote_asset_volume", "number_of_trades",
        "taker_buy_base_volume", "taker_buy_quote_volume")
    history = b.join(newest.select("symbol", "open_time"), ["symbol", "open_time"], "left_anti")
    return history, req


def request_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(history, requests) of a scoring batch that grows with ``customer``: each
    customer asks for one symbol (every 11th for one without candles), one
    minute before to two minutes after its newest candle, so a part of the
    requests is stale; every 13th lacks the open price. History is every candle."""
    from kandela.operators.topk import latest_row
    b = bronze(spark, sf_dir, MINUTE, keyed=True)
    newest = latest_row(b, ["symbol"])
    symbols = newest.withColumn("_k", F.row_number().over(Window.orderBy("symbol")) - 1)  # a row for each symbol
    n = symbols.agg(F.count(F.lit(1))).scalar()
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(key, F.when(key % 11 != 0, (key % n).cast("int")).alias("_k"))
    rows = c.join(symbols, "_k", "left")
    at = F.coalesce("open_time", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return b, rows.select(
        key.alias("request_id"), F.coalesce("symbol", F.lit("none")).alias("symbol"), key.alias("user_id"),
        (at + F.make_dt_interval(mins=(key % 4 - 1).cast("int"))).alias("requested_at"),
        F.when(key % 13 != 0, F.coalesce("open", F.lit(1.0))).alias("open_price"),
        F.coalesce("high", F.lit(1.0)).alias("high_price"), F.coalesce("low", F.lit(1.0)).alias("low_price"),
        (F.coalesce("close", F.lit(1.0)) + key % 10).alias("close_price"),
        F.coalesce("volume", F.lit(1.0)).alias("volume"), F.coalesce("quote_asset_volume", F.lit(1.0)).alias("quote_asset_volume"),
        F.coalesce("number_of_trades", F.lit(1)).alias("number_of_trades"),
        F.coalesce("taker_buy_base_volume", F.lit(1.0)).alias("taker_buy_base_volume"),
        F.coalesce("taker_buy_quote_volume", F.lit(1.0)).alias("taker_buy_quote_volume"))
