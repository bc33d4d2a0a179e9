"""Online features in event time (R-3).

Candles may come in any order inside an allowed delay. A symbol's candles wait in state until the watermark has
passed them, so that no earlier one is awaited; then they come out in the order of their times, with the features
that the batch build gives them. A candle that comes after later ones came out is not lost: it comes out at once,
marked ``late``, without features; of candles of one time the one with the greatest values counts, and the others
come out marked ``repeat``. So there is one row out for each row in, whatever the files and their order.

The state of a symbol is the list of waiting candles (appended to, and read only when the watermark moves past
the oldest one) and the last nine closes. ``transformWithStateInPandas`` calls Python once for each symbol and
micro-batch; the features of all candles that come out together are computed with NumPy. It needs the RocksDB
state store (``start`` sets it for the query).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kandela.schema import BRONZE
from kandela.session import pin_utc
from kandela.streaming.online import HISTORY, _features

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
VALUES = [f.name for f in BRONZE.fields if f.name not in ("open_time", "close_time")]
_TYPES = {f.name: f.dataType.simpleString() for f in BRONZE.fields}
_HELD = ", ".join(["t long", *(f"{c} {_TYPES[c]}" for c in VALUES)])
OUTPUT = (", ".join(["symbol string", "open_time timestamp_ntz", *(f"{c} {_TYPES[c]}" for c in VALUES)])
          + ", return_1m double, MA_5 double, MA_10 double, taker_ratio double, status string")


class OrderedFeatures(StatefulProcessor):
    """Holds a symbol's candles until the watermark has passed them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        self.last = handle.getValueState("last", "t long, closes array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        after = self.last.get()[0] if self.last.exists() else None
        late = new["t"] <= after if after is not None else pd.Series(False, index=new.index)
        wait = new[~late]
        if len(wait):
            self.held.appendList([tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r) for r in wait[["t", *VALUES]].itertuples(index=False)])
            self.handle.registerTimer(_millis(int(wait["t"].min())))
        if late.any():
            yield _out(key[0], new[late], status="late")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = 1000 * timerValues.getCurrentWatermarkInMs()
        held = pd.DataFrame(list(self.held.get()), columns=["t", *VALUES])
        if not len(held):
            return
        go = held["t"] <= passed
        rest = held[~go]
        if len(rest):
            self.held.put([tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r) for r in rest.itertuples(index=False)])
            self.handle.registerTimer(_millis(int(rest["t"].min())))
        else:
            self.held.clear()
        ready = held[go].sort_values(["t", *VALUES], kind="stable", na_position="first")
        if not len(ready):
            return
        repeat = ready["t"].duplicated(keep="last")
        if repeat.any():
            yield _out(key[0], ready[repeat], status="repeat")
        ready = ready[~repeat]
        before = list(self.last.get()[1]) if self.last.exists() else []
        closes = np.concatenate([np.array([np.nan if c is None else c for c in before], float), ready["close"].to_numpy(float)])
        self.last.update((int(ready["t"].iloc[-1]), [None if np.isnan(c) else float(c) for c in closes[-HISTORY:]]))
        yield _out(key[0], ready, _features(closes, len(before)))

    def close(self) -> None:
        pass


def _millis(t: int) -> int:
    return -(-t // 1000)


def _out(symbol: str, rows: pd.DataFrame, features=None, status: str = "ok") -> pd.DataFrame:
    """Rows as they come out; the taker ratio follows the serving rule (0 without volume)."""
    out = pd.DataFrame({"symbol": symbol, "open_time": rows["t"].to_numpy("int64").view("datetime64[us]")})
    for c in VALUES:
        out[c] = pd.array(rows[c].to_numpy(), dtype="Int64") if _TYPES[c] == "bigint" else rows[c].to_numpy(float)
    empty = np.full(len(rows), np.nan)
    for c, v in zip(("return_1m", "MA_5", "MA_10"), features or (empty,) * 3, strict=True):
        out[c] = v
    volume, taker = out["volume"].to_numpy(), out["taker_buy_base_volume"].to_numpy()
    with np.errstate(divide="ignore", invalid="ignore"):
        out["taker_ratio"] = np.where(volume > 0, taker / np.where(volume > 0, volume, 1.0), 0.0) if features else empty
    out["status"] = status
    return out


def ordered_features(bars: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream of candles (``symbol`` and the bronze columns) with features, in the order of time for each symbol.

    ``delay`` is how much older than the newest candle seen a candle may be and still be put in its place. Candles
    without a time can be put nowhere; landing has set them aside, and they are left out here."""
    pin_utc(bars.sparkSession)
    t = bars.filter(F.col("open_time").isNotNull()).withColumn("_ts", F.col("open_time").cast("timestamp")).withWatermark("_ts", delay)
    # a number without the watermark's mark: Spark would drop marked rows that are behind it
    rows = t.select("symbol", F.unix_micros("_ts").alias("t"), *VALUES)
    return rows.groupBy("symbol").transformWithStateInPandas(OrderedFeatures(), OUTPUT, "append", "EventTime").select(
        *[F.col(c) if c not in ("return_1m", "MA_5", "MA_10", "taker_ratio") else F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in _names()])


def _names() -> list[str]:
    return [c.split(" ")[0] for c in OUTPUT.split(", ")]


def start(writer: DataStreamWriter, spark, path: str | None = None) -> StreamingQuery:
    """Starts a query with the state store that it needs; the session's own setting stays."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return writer.start(path) if path else writer.start()
    finally:
        spark.conf.set(_PROVIDER, before)
