"""Fixture builder B-0: tick rows -> candle rows.

Not a reference operator: the driver data has ticks (``events``), not candles.
One ``groupBy`` over (symbol?, tumbling window); every aggregate is declarative
(partial + final aggregation, map-side combine), so a hot symbol or a hot
minute is pre-aggregated before the shuffle and never collected into a group.

Conventions (FIXTURES.md): ``value`` is trade price *and* size; an even
``user_id`` marks a taker buy. Volume sums are rounded to 6 decimals so two
engines that add in different orders agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def width_seconds(width: str) -> int:
    """'1 hour' / 'hour' / '5 minutes' -> seconds."""
    parts = width.strip().lower().split()
    n, unit = (1, parts[0]) if len(parts) == 1 else (int(parts[0]), parts[1])
    unit = unit.rstrip("s")
    if unit not in _UNITS:
        raise ValueError(f"unsupported bar width {width!r}")
    return n * _UNITS[unit]


def bars(events: DataFrame, width: str = "1 hour", time_col: str = "ts",
         price_col: str = "value", taker_col: str = "user_id",
         symbol_col: str | None = None, decimals: int = 6, tie_col: str | None = "event_id") -> DataFrame:
    """Candles of ``width`` from tick rows; keyed by ``symbol`` when
    ``symbol_col`` is given. Columns follow the bronze schema. Ticks of the same
    time are ordered by ``tie_col`` (then by price), so open and close are the
    same in every run."""
    tie = [F.col(tie_col).alias("_i")] if tie_col and tie_col in events.columns else []
    order = F.struct("_t", *["_i" for _ in tie], "_p")
    secs = width_seconds(width)
    span = f"{secs} seconds"
    price = F.col(price_col)
    taker = (F.col(taker_col) % 2) == 0
    keys = [F.col(symbol_col).alias("symbol")] if symbol_col else []
    start = F.window(time_col, span).start.alias("open_time")
    agg = (events
           .select(*keys, start, F.col(time_col).alias("_t"), *tie, price.alias("_p"),
                   taker.alias("_tk"))
           .groupBy(*(["symbol"] if symbol_col else []), "open_time")
           .agg(F.min_by("_p", order).alias("open"),
                F.max("_p").alias("high"),
                F.min("_p").alias("low"),
                F.max_by("_p", order).alias("close"),
                F.round(F.sum("_p"), decimals).alias("volume"),
                F.round(F.sum(F.col("_p") * F.col("_p")), decimals).alias("quote_asset_volume"),
                F.count(F.lit(1)).alias("number_of_trades"),
                F.round(F.sum(F.when(F.col("_tk"), F.col("_p")).otherwise(F.lit(0.0))),
                        decimals).alias("taker_buy_base_volume"),
                F.round(F.sum(F.when(F.col("_tk"), F.col("_p") * F.col("_p"))
                              .otherwise(F.lit(0.0))), decimals).alias("taker_buy_quote_volume")))
    close_time = (F.col("open_time") + F.expr(f"INTERVAL {secs} SECONDS")
                  - F.expr("INTERVAL 1 MILLISECOND"))
    cols = (["symbol"] if symbol_col else []) + [
        "open_time", "open", "high", "low", "close", "volume",
        close_time.alias("close_time"), "quote_asset_volume", "number_of_trades",
        "taker_buy_base_volume", "taker_buy_quote_volume"]
    return agg.select(*cols)
