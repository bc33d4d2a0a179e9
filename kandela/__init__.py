"""kandela: Spark-native candle (OHLCV) features, training and scoring.

Everything is DataFrame in, DataFrame out and lazy; nothing is collected to the
driver inside an operator. Sub-packages:

* ``sources``   - scans, payload parsing, JDBC, sinks
* ``functions`` - column expressions (ratios, returns, horizons, fences)
* ``operators`` - bar builder, ordered-series windows (dense index + halo
  blocks), feature build, quality profile, split, top-k, relations
* ``plans``     - composite jobs: silver build, model training/evaluation,
  set-based scoring, settlement, monitoring, and the query registry
* ``streaming`` - Structured Streaming ingest, de-duplication, online
  features and scoring
"""

__version__ = "0.1.0"

from kandela.operators.bars import bars  # noqa: E402,F401
from kandela.operators.features import add_features, numeric_columns, refit_features, silver  # noqa: E402,F401
from kandela.operators.ordered import dense_index, ordered_window, time_index  # noqa: E402,F401
from kandela.operators.split import chronological_split  # noqa: E402,F401
from kandela.plans.model import (assemble, evaluate, fit_linear, load_model,  # noqa: E402,F401
                                 regression_metrics, save_model)
from kandela.plans.scoring import score_candidates  # noqa: E402,F401
from kandela.plans.settlement import monitor_daily, settle  # noqa: E402,F401
from kandela.plans.training import run_training  # noqa: E402,F401
from kandela.sources.payload import parse_klines  # noqa: E402,F401

__all__ = [
    "add_features", "assemble", "bars", "chronological_split", "dense_index", "evaluate",
    "fit_linear", "load_model", "monitor_daily", "numeric_columns", "ordered_window",
    "parse_klines", "refit_features", "regression_metrics", "run_training", "save_model",
    "score_candidates", "settle", "silver", "time_index",
]
