"""Schemas and fixed column lists of the candle data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's ---------------------------
# Positional field names of one kline (exchange payload order).
KLINE_FIELDS = [
    "open_time", "open", "high", "low", "close", "volume",
    "close_time", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_volume", "taker_buy_quote_volume", "ignore",
]
# Text fields of a kline that are cast to double.
KLINE_DOUBLE_FIELDS = [
    "open", "high", "low", "close", "volume",
    "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume",
]
# The 13 model features, in training order (the linear model is positional).
FEATURE_COLUMNS = [
    "open", "high", "low", "close", "volume",
    "quote_asset_volume", "number_of_trades",
    "taker_buy_base_volume", "taker_buy_quote_volume",
    "return_1m", "MA_5", "MA_10", "taker_ratio",
]
LABEL = "close_t_plus_10"
HORIZON = 10
MODEL_VERSION = "v1.0.0"
# dtype names kept by the numeric-column choice
NUMERIC_DTYPES = ["int", "bigint", "double", "float"]
# -----------------------------------------------------------------------------

BAR_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "number_of_trades",
    "taker_buy_base_volume", "taker_buy_quote_volume",
]
DERIVED_COLUMNS = [LABEL, "return_1m", "MA_5", "MA_10", "taker_ratio"]

BRONZE = T.StructType([
    T.StructField("open_time", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("close_time", T.TimestampNTZType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("number_of_trades", T.LongType()),
    T.StructField("taker_buy_base_volume", T.DoubleType()),
    T.StructField("taker_buy_quote_volume", T.DoubleType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("symbol", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("requested_at", T.TimestampNTZType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("number_of_trades", T.LongType()),
    T.StructField("taker_buy_base_volume", T.DoubleType()),
    T.StructField("taker_buy_quote_volume", T.DoubleType()),
])

PREDICTION = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("user_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("prediction_for", T.TimestampNTZType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("predicted_price", T.DoubleType()),
    T.StructField("actual_price", T.DoubleType()),
    T.StructField("confidence_lower", T.DoubleType()),
    T.StructField("confidence_upper", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("error", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


def with_keys(schema: T.StructType, keys=("symbol",)) -> T.StructType:
    """Prefix a schema with string key columns (e.g. ``symbol``)."""
    return T.StructType([T.StructField(k, T.StringType()) for k in keys] + list(schema.fields))
