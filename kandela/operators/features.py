"""Feature build (W-1 ... W-4, X-1/X-2, F-4, M-1).

One window pass computes target, previous close and both moving averages; the
ratio and return are plain projections on top. ``lag(close, 1)`` is defined once
(Catalyst does not merge the two copies the reference writes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from kandela.functions.scalar import safe_return, taker_ratio
from kandela.operators.ordered import (DEFAULT_BLOCK_ROWS, DEFAULT_BUCKET,
                                       ordered_window)
from kandela.schema import BAR_COLUMNS, HORIZON, LABEL, NUMERIC_DTYPES


def _series_order(df: DataFrame, time_col: str) -> list[str]:
    """Time first, then every other bar column: a total, deterministic order
    even when a candle is duplicated (G12)."""
    rest = [c for c in BAR_COLUMNS if c in df.columns and c != time_col]
    return [time_col] + rest


def add_features(bars: DataFrame, keys: Sequence[str] = (), time_col: str = "open_time",
                 horizon: int = HORIZON, ma: Sequence[int] = (5, 10),
                 ratio_on_zero: str = "null", method: str = "halo",
                 block_rows: int = DEFAULT_BLOCK_ROWS,
                 bucket_unit: str = DEFAULT_BUCKET, with_target: bool = True) -> DataFrame:
    """Bars -> bars + ``close_t_plus_10, return_1m, MA_5, MA_10, taker_ratio``.

    ROWS semantics like the reference (G3, E7): the target is the close
    ``horizon`` *rows* ahead and the first rows use partial MA frames. Nothing is
    dropped here; see :func:`silver`.

    ``method``: ``"halo"`` (default; any series density, two exchanges),
    ``"edges"`` (one exchange; ``bucket_unit`` must hold many more than
    ``horizon + max(ma) - 1`` rows, e.g. "day" for minute candles, "month" for
    hourly ones) or ``"global"`` (plain per-key window; small keys only). All
    three return the same rows.
    """
    ma = list(ma)

    def cols(w: WindowSpec) -> dict:
        out = {}
        if with_target:
            out[LABEL] = F.lead("close", horizon).over(w)
        out["_prev_close"] = F.lag("close", 1).over(w)
        for n in ma:
            out[f"MA_{n}"] = F.avg("close").over(w.rowsBetween(-(n - 1), 0))
        return out

    back = max([1] + [n - 1 for n in ma])
    fwd = horizon if with_target else 0
    out = ordered_window(bars, cols, _series_order(bars, time_col), keys, back=back, fwd=fwd,
                         method=method, block_rows=block_rows, bucket_unit=bucket_unit)
    derived = {LABEL: F.col(LABEL)} if with_target else {}
    derived["return_1m"] = safe_return("close", "_prev_close")
    for n in ma:
        derived[f"MA_{n}"] = F.col(f"MA_{n}")
    derived["taker_ratio"] = taker_ratio(on_zero=ratio_on_zero)
    base = [c for c in bars.columns if c not in derived]
    return out.select(*base, *[v.alias(k) for k, v in derived.items()])


def silver(bars: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """The silver table: features, then drop rows without target or return (G4).
    Drops ``ignore`` when present."""
    feats = add_features(bars, keys, **kw)
    if "ignore" in feats.columns:
        feats = feats.drop("ignore")
    return feats.na.drop(subset=[LABEL, "return_1m"])


def numeric_columns(df: DataFrame, label: str = LABEL,
                    dtypes: Sequence[str] = tuple(NUMERIC_DTYPES)) -> list[str]:
    """Numeric-column choice by dtype name, minus the label (P-8, M-2)."""
    return [c for c, t in df.dtypes if t in dtypes and c != label]


def refit_features(silver_df: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """The training-job variant (G5): recompute return, MAs and ratio on silver
    (history is cut, so early values change), then drop rows with a NULL or NaN
    in any numeric feature or the label."""
    base = silver_df.drop("return_1m", "MA_5", "MA_10", "taker_ratio")
    feats = add_features(base, keys, with_target=False, **kw)
    cols = numeric_columns(feats)
    return feats.na.drop(subset=cols + [LABEL])
