"""Column expressions (X-1 ... X-7, P-5, F-3, F-6).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Divisions use ``try_divide``: under ANSI mode a plain ``/`` by zero raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def taker_ratio(taker_base="taker_buy_base_volume", volume="volume",
                on_zero: str = "null") -> Column:
    """Share of volume bought by takers.

    ``on_zero="null"``: NULL when volume is 0 (the silver/training rule, made
    ANSI-safe). ``on_zero="zero"``: 0.0 unless volume > 0 (the serving rule).
    """
    tb, v = _c(taker_base), _c(volume)
    if on_zero == "zero":
        return F.when(v > 0, tb / v).otherwise(F.lit(0.0))
    if on_zero == "null":
        return F.try_divide(tb, v)
    raise ValueError(f"on_zero must be 'null' or 'zero', not {on_zero!r}")


def safe_return(current, previous) -> Column:
    """(current - previous) / previous, NULL when previous is 0 or NULL."""
    cur, prev = _c(current), _c(previous)
    return F.try_divide(cur - prev, prev)


def predicted_change_pct(predicted="predicted_price", current="current_price") -> Column:
    """Predicted move in percent of the current price."""
    return F.try_divide(_c(predicted) - _c(current), _c(current)) * F.lit(100.0)


def horizon_time(ts="timestamp", minutes: int = 10) -> Column:
    """``ts`` plus a fixed horizon (type of ``ts`` is kept)."""
    return _c(ts) + F.make_dt_interval(mins=F.lit(minutes))


def epoch_seconds(ts) -> Column:
    """Timestamp (LTZ or NTZ) to whole epoch seconds, as bigint."""
    return F.unix_timestamp(_c(ts)).cast("bigint")


def candle_close_epoch(open_epoch, width_seconds: int = 60) -> Column:
    """Epoch seconds at which a candle opened at ``open_epoch`` closes."""
    return _c(open_epoch) + F.lit(width_seconds)


def candle_close_time(open_time="open_time", width_seconds: int = 60) -> Column:
    """Close time of a candidate candle opened at ``open_time`` (NTZ or LTZ):
    ``open_time + width``, as the serving path sets it for a new candle."""
    return _c(open_time) + F.expr(f"INTERVAL {int(width_seconds)} SECONDS")


def iqr_fences(q1, q3, k: float = 1.5) -> tuple[Column, Column]:
    """Tukey fences (q1 - k*IQR, q3 + k*IQR)."""
    lo, hi = _c(q1), _c(q3)
    iqr = hi - lo
    return lo - F.lit(k) * iqr, hi + F.lit(k) * iqr


def outside(x, lower, upper) -> Column:
    """x < lower OR x > upper, false (not NULL) when x is NULL."""
    x = _c(x)
    return F.coalesce((x < _c(lower)) | (x > _c(upper)), F.lit(False))
