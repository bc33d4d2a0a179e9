"""Online features per symbol (R-3).

A streaming ``lag``/ROWS window is refused by Spark
(``NON_TIME_WINDOW_NOT_SUPPORTED_IN_STREAMING``), so the per-symbol history is
carried in state: the last nine closes and the last candle time.
``groupBy(symbol).applyInPandasWithState`` runs one small pandas function per
symbol and micro-batch; the group holds only that symbol's new candles of the
trigger interval (bounded by ``maxFilesPerTrigger`` on a backlog).

Rows inside a micro-batch are sorted by time before the state update; a candle
not newer than the state's last candle is late: it is not used and is counted
in ``late_rows`` on the next emitted row of its symbol (no timeout needed).
The taker ratio uses the serving rule by default (0.0 on zero volume).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HISTORY = 9  # closes kept: MA_10 needs 9 previous closes, return_1m needs 1

VALUE_COLS = ["open", "high", "low", "close", "volume", "quote_asset_volume",
              "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume"]

OUTPUT_SCHEMA = (
    "symbol string, open_time timestamp_ntz, open double, high double, low double, "
    "close double, volume double, quote_asset_volume double, number_of_trades bigint, "
    "taker_buy_base_volume double, taker_buy_quote_volume double, return_1m double, "
    "MA_5 double, MA_10 double, taker_ratio double, late_rows bigint")
STATE_SCHEMA = "last_us long, n long, late long, " + ", ".join(f"c{i} double" for i in range(HISTORY))


def _trailing_mean(c: np.ndarray, k: int, start: int) -> np.ndarray:
    """Mean of the last ``k`` values (fewer at the series start) for positions
    ``start..`` of ``c``, without the missing ones (NaN where all are missing),
    as the batch ``avg`` skips NULLs; vectorized, each window summed in order."""
    padded = np.concatenate([np.full(k - 1, np.nan), c])
    win = np.lib.stride_tricks.sliding_window_view(padded, k)[start:]
    seen = ~np.isnan(win)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(seen, win, 0.0).sum(axis=1) / np.where(seen.any(axis=1), seen.sum(axis=1), np.nan)


def _features(closes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return, MA_5, MA_10 for positions ``start..`` of the close history."""
    n = len(closes)
    prev = np.concatenate([[np.nan], closes[:-1]])[start:n]
    cur = closes[start:n]
    with np.errstate(divide="ignore", invalid="ignore"):
        ret = np.where((prev != 0) & ~np.isnan(prev), (cur - prev) / prev, np.nan)
    return ret, _trailing_mean(closes, 5, start), _trailing_mean(closes, 10, start)


def make_update(ratio_on_zero: str = "zero"):
    def update(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            last_us, n_prev, late, *hist = state.get
            hist = [h for h in hist[:n_prev]]
        else:
            last_us, n_prev, late, hist = None, 0, 0, []
        pdf = pd.concat(list(pdfs), ignore_index=True)
        pdf = pdf.sort_values("open_time", kind="stable")
        t_us = pdf["open_time"].astype("datetime64[us]").astype("int64").to_numpy()
        # sorted by time: keep a candle if newer than the state's last one and
        # than the previous candle of the batch (first copy of a repeated time)
        keep = np.ones(len(pdf), dtype=bool)
        if last_us is not None:
            keep &= t_us > last_us
        keep[1:] &= t_us[1:] > t_us[:-1]
        late += int((~keep).sum())
        pdf = pdf[keep]
        if len(pdf) == 0:
            state.update((last_us, n_prev, late, *([*hist] + [0.0] * (HISTORY - len(hist)))))
            return
        closes = np.concatenate([np.asarray(hist, dtype=float),
                                 pdf["close"].to_numpy(dtype=float)])
        ret, ma5, ma10 = _features(closes, len(hist))
        out = pdf[["symbol", "open_time", *VALUE_COLS]].copy()
        out["return_1m"] = ret
        out.loc[np.isnan(ret), "return_1m"] = None
        out["MA_5"] = ma5
        out["MA_10"] = ma10
        vol = out["volume"].to_numpy(dtype=float)
        tb = out["taker_buy_base_volume"].to_numpy(dtype=float)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(vol > 0, tb / np.where(vol > 0, vol, 1.0),
                             0.0 if ratio_on_zero == "zero" else np.nan)
        out["taker_ratio"] = ratio
        out["late_rows"] = late
        new_hist = list(closes[-HISTORY:])
        state.update((int(t_us[keep][-1]), len(new_hist), late,
                      *(new_hist + [0.0] * (HISTORY - len(new_hist)))))
        yield out
    return update


def online_features(bars: DataFrame, ratio_on_zero: str = "zero") -> DataFrame:
    """Streaming bars -> serving features per symbol, in order (a streaming
    frame is required: ``applyInPandasWithState`` is streaming-only)."""
    cols = ["symbol", "open_time", *VALUE_COLS]
    return (bars.select(*cols).groupBy("symbol")
            .applyInPandasWithState(make_update(ratio_on_zero), OUTPUT_SCHEMA, STATE_SCHEMA,
                                    "append", GroupStateTimeout.NoTimeout))
