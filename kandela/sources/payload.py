"""Kline payloads (S-1, P-2 ... P-4).

The exchange answers with a JSON list of 12-element lists (numbers as text for
prices and volumes, epoch milliseconds for times). Parsing is JVM-side:
``from_json`` to ``array<array<string>>``, ``explode``, positional fields,
casts. Payload files are read with ``wholetext`` (one document per file) or one
document per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kandela.schema import KLINE_DOUBLE_FIELDS, KLINE_FIELDS

PAYLOAD_TYPE = "array<array<string>>"
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ntz_from_epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds -> UTC wall-clock ``timestamp_ntz``, independent of
    the session time zone (NTZ plus an exact interval)."""
    secs = ms.cast("decimal(20,3)") / F.lit(1000)
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def epoch_millis_from_ntz(ts: Column) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> epoch milliseconds (bigint),
    independent of the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def _field(kline: Column, name: str) -> Column:
    x = kline[KLINE_FIELDS.index(name)]
    if name in ("open_time", "close_time"):
        return ntz_from_epoch_millis(x.cast("bigint")).alias(name)
    if name in KLINE_DOUBLE_FIELDS:
        return x.cast("double").alias(name)
    if name == "number_of_trades":
        return x.cast("bigint").alias(name)
    return x.alias(name)


def parse_klines(payloads: DataFrame, column: str = "value",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Payload text column -> one typed bronze row per kline (with ``ignore``)."""
    k = payloads.select(*keep, F.explode(F.from_json(F.col(column), PAYLOAD_TYPE)).alias("_k"))
    return k.select(*keep, *[_field(F.col("_k"), n) for n in KLINE_FIELDS])


def read_payload_files(spark: SparkSession, path: str, whole_file: bool = True, symbol: str | None = None) -> DataFrame:
    """Batch read of landed payload files: one JSON document per file
    (``whole_file``) or per line, with ``symbol`` taken from a ``symbol=...``
    folder (else the parameter) and the file's modification time as ``fetched_at``."""
    return with_file_info(spark.read.option("wholetext", str(whole_file).lower()).text(path), symbol)


def with_file_info(docs: DataFrame, symbol: str | None = None) -> DataFrame:
    """Payload text plus ``symbol`` (from a ``symbol=...`` folder, else the parameter: payloads of one
    symbol need no folder) and ``fetched_at`` (file modification time, UTC wall clock under a UTC
    session). A file of unknown symbol is refused with its name."""
    file = F.col("_metadata.file_path")
    named = F.nullif(F.regexp_extract(file, r"symbol=([^/]+)", 1), F.lit(""))
    unknown = F.raise_error(F.concat(F.lit("no symbol is known for the payload file "), file)).cast("string")
    return docs.select(
        "value",
        F.coalesce(named, F.lit(symbol) if symbol else unknown).alias("symbol"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("fetched_at"))


def _num_text(c: str) -> Column:
    # shortest round-trip text of a double, as the exchange sends decimals
    return F.col(c).cast("string")


def to_payloads(bars: DataFrame, keys: Sequence[str] = (), per: str = "day") -> DataFrame:
    """Bars -> payload documents, one per key and ``per`` period (a day of
    minute candles is at most 1,440 klines, so each group is bounded).
    Output: keys..., period, value (JSON text)."""
    kline = F.array(
        epoch_millis_from_ntz(F.col("open_time")).cast("string"),
        _num_text("open"), _num_text("high"), _num_text("low"), _num_text("close"),
        _num_text("volume"),
        epoch_millis_from_ntz(F.col("close_time")).cast("string"),
        _num_text("quote_asset_volume"), F.col("number_of_trades").cast("string"),
        _num_text("taker_buy_base_volume"), _num_text("taker_buy_quote_volume"),
        F.lit("0"))
    g = bars.select(*keys, F.window("open_time", f"1 {per}").start.alias("period"),
                    F.col("open_time").alias("_t"), kline.alias("_k"))
    agg = g.groupBy(*keys, "period").agg(
        F.sort_array(F.collect_list(F.struct("_t", "_k"))).alias("_ks"))
    return agg.select(*keys, "period",
                      F.to_json(F.col("_ks._k")).alias("value"))
