from kandela.functions.scalar import (  # noqa: F401
    candle_close_epoch,
    candle_close_time,
    epoch_seconds,
    horizon_time,
    iqr_fences,
    outside,
    predicted_change_pct,
    safe_return,
    taker_ratio,
)
