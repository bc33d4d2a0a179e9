"""DuckDB SQL oracles, one per SQL-checkable query key.

Independent formulations of the same results over the driver's views
(``events``, ``customer``, ...). Doubles that are computed (ratios, averages,
metrics) are rounded to 6 decimals here and on the Spark side.
"""

from __future__ import annotations

R = 6  # decimals


def bars_sql(unit: str = "hour", keyed: bool = False) -> str:
    sym = "event_type AS symbol, " if keyed else ""
    grp = "symbol, open_time" if keyed else "open_time"
    return f"""
SELECT {sym}date_trunc('{unit}', ts)::TIMESTAMP AS open_time,
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close,
       round(sum(value), {R}) AS volume,
       date_trunc('{unit}', ts)::TIMESTAMP + INTERVAL 1 {unit} - INTERVAL 1 MILLISECOND AS close_time,
       round(sum(value * value), {R}) AS quote_asset_volume,
       count(*) AS number_of_trades,
       round(sum(CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END), {R}) AS taker_buy_base_volume,
       round(sum(CASE WHEN user_id % 2 = 0 THEN value * value ELSE 0.0 END), {R}) AS taker_buy_quote_volume
FROM events GROUP BY {grp}"""


def features_sql(src: str, keyed: bool = False, ratio: str = "null") -> str:
    part = "PARTITION BY symbol " if keyed else ""
    w = f"({part}ORDER BY open_time)"
    if ratio == "null":
        tr = "taker_buy_base_volume / nullif(volume, 0)"
    else:
        tr = "CASE WHEN volume > 0 THEN taker_buy_base_volume / volume ELSE 0.0 END"
    return f"""
SELECT *,
       lead(close, 10) OVER {w} AS close_t_plus_10,
       (close - lag(close) OVER {w}) / nullif(lag(close) OVER {w}, 0) AS return_1m,
       avg(close) OVER ({part}ORDER BY open_time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS MA_5,
       avg(close) OVER ({part}ORDER BY open_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS MA_10,
       {tr} AS taker_ratio
FROM ({src}) b"""


def rounded(sql: str, cols) -> str:
    """Wrap ``sql`` so the listed double columns are rounded."""
    rep = ", ".join(f"round({c}, {R}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


DERIVED = ["return_1m", "MA_5", "MA_10", "taker_ratio"]


def silver_sql(unit: str = "hour", keyed: bool = False) -> str:
    feat = features_sql(bars_sql(unit, keyed), keyed)
    return (f"SELECT * FROM ({feat}) f "
            "WHERE close_t_plus_10 IS NOT NULL AND return_1m IS NOT NULL "
            "AND NOT isnan(close_t_plus_10) AND NOT isnan(return_1m)")


def silver_rounded(unit: str = "hour", keyed: bool = False) -> str:
    return rounded(silver_sql(unit, keyed), DERIVED)


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    o["silver_features"] = silver_rounded("hour")
    o["features_halo"] = silver_rounded("minute", keyed=True)
    o["features_edges"] = silver_rounded("minute", keyed=True)
    o["scan_bars"] = f"SELECT *, CAST(open_time AS DATE) AS dt FROM ({bars_sql('minute', True)}) b"
    o["project_bars"] = f"""
SELECT floor(epoch(open_time))::BIGINT AS open_time, open, high, low, close, volume,
       floor(epoch(close_time))::BIGINT AS close_time, quote_asset_volume, number_of_trades,
       taker_buy_base_volume, taker_buy_quote_volume
FROM ({bars_sql('hour')}) b"""
    feat_h = features_sql(bars_sql("hour"), False)
    o["target_lead10"] = f"SELECT open_time, close, close_t_plus_10 FROM ({feat_h}) f"
    o["return_1m"] = rounded(f"SELECT open_time, close, return_1m FROM ({feat_h}) f",
                             ["return_1m"])
    o["moving_averages"] = rounded(f"SELECT open_time, close, MA_5, MA_10 FROM ({feat_h}) f",
                                   ["MA_5", "MA_10"])
    o["taker_ratio"] = rounded(
        f"SELECT open_time, volume, taker_buy_base_volume, "
        f"taker_buy_base_volume / nullif(volume, 0) AS taker_ratio FROM ({bars_sql('minute')}) b",
        ["taker_ratio"])
    o["taker_ratio_guarded"] = rounded(
        f"SELECT open_time, volume, taker_buy_base_volume, "
        f"CASE WHEN volume > 0 THEN taker_buy_base_volume / volume ELSE 0.0 END AS taker_ratio "
        f"FROM ({bars_sql('minute')}) b", ["taker_ratio"])
    o["time_index"] = (f"SELECT symbol, open_time, close, "
                       f"row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS rn "
                       f"FROM ({bars_sql('minute', True)}) b")
    _more(o)
    return o


NUMERIC_SILVER = ["open", "high", "low", "close", "volume", "quote_asset_volume",
                  "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
                  "close_t_plus_10", "return_1m", "MA_5", "MA_10", "taker_ratio"]
FEATURES13 = ["open", "high", "low", "close", "volume", "quote_asset_volume",
              "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
              "return_1m", "MA_5", "MA_10", "taker_ratio"]
FEATURE_TABLE = ["open_time", "open", "high", "low", "close", "volume", "close_time",
                 "quote_asset_volume", "number_of_trades", "taker_buy_base_volume",
                 "taker_buy_quote_volume", "close_t_plus_10", "return_1m", "MA_5", "MA_10",
                 "taker_ratio"]


def predictions_sql() -> str:
    feat = features_sql(bars_sql("minute", True), True)
    return f"""
SELECT (floor(epoch(open_time) / 60)::BIGINT % (SELECT count(*) FROM customer)) + 1 AS user_id, symbol,
       open_time AS timestamp, open_time + INTERVAL 10 MINUTE AS prediction_for,
       close AS current_price, MA_5 AS predicted_price, NULL::DOUBLE AS actual_price,
       'v1.0.0' AS model_version, NULL::DOUBLE AS error
FROM ({feat}) f"""


USERS = ("SELECT c_custkey AS user_id, c_name AS username, "
         "lower(replace(c_name, '#', '.')) || '@example.com' AS email, "
         "TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM customer")


def _split(cmp: str) -> str:
    return f"""
SELECT open_time, close, close_t_plus_10, rn FROM (
  SELECT open_time, close, close_t_plus_10,
         row_number() OVER (ORDER BY open_time) AS rn, count(*) OVER () AS n
  FROM ({silver_sql('minute')}) s) i
WHERE rn {cmp} floor(n * 0.8)"""


def _flag() -> str:
    return f"""
WITH s AS ({silver_sql('hour')}),
q AS (SELECT quantile_disc(close_t_plus_10, 0.25) AS q1,
             quantile_disc(close_t_plus_10, 0.75) AS q3 FROM s)
SELECT open_time, close_t_plus_10,
       coalesce(close_t_plus_10 < q1 - 1.5 * (q3 - q1)
                OR close_t_plus_10 > q3 + 1.5 * (q3 - q1), false) AS is_outlier
FROM s, q"""


def _settled() -> str:
    return f"""
SELECT p.user_id, p.symbol, p.timestamp, p.prediction_for, p.current_price, p.predicted_price,
       b.close AS actual_price, p.model_version, p.predicted_price - b.close AS error
FROM ({predictions_sql()}) p
LEFT JOIN ({bars_sql('minute', True)}) b
  ON b.symbol = p.symbol AND b.open_time = date_trunc('minute', p.prediction_for)"""


def request_features_sql() -> str:
    """Serving features and status of every request of the batch fixture."""
    return f"""
WITH b AS ({bars_sql('minute', True)}),
last AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1),
newest AS (SELECT *, row_number() OVER (ORDER BY symbol) - 1 AS k FROM last),
req AS (
  SELECT c_custkey AS request_id, coalesce(symbol, 'none') AS symbol,
         coalesce(open_time, TIMESTAMP '2024-01-01 00:00:00') + to_minutes(CAST(c_custkey % 4 - 1 AS INTEGER)) AS open_time,
         CASE WHEN c_custkey % 13 <> 0 THEN coalesce(open, 1.0) END AS open, coalesce(close, 1.0) + c_custkey % 10 AS close,
         coalesce(volume, 1.0) AS volume, coalesce(taker_buy_base_volume, 1.0) AS taker_buy_base_volume
  FROM customer LEFT JOIN newest ON c_custkey % 11 <> 0 AND k = c_custkey % (SELECT count(*) FROM newest)),
hist AS (SELECT symbol, open_time, close, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS i FROM b
         QUALIFY i <= 10),
h AS (SELECT symbol, max(open_time) AS newest, max(CASE WHEN i = 1 THEN close END) AS prev,
             sum(CASE WHEN i <= 4 THEN close END) AS s4, count(CASE WHEN i <= 4 THEN close END) AS n4,
             sum(CASE WHEN i <= 9 THEN close END) AS s9, count(CASE WHEN i <= 9 THEN close END) AS n9 FROM hist GROUP BY symbol),
f AS (
  SELECT request_id, req.symbol, req.open_time, req.open_time + INTERVAL 60 SECOND AS close_time, req.open, req.close, newest,
         (req.close - prev) / nullif(prev, 0) AS return_1m,
         (coalesce(s4, 0) + req.close) / (coalesce(n4, 0) + 1) AS MA_5, (coalesce(s9, 0) + req.close) / (coalesce(n9, 0) + 1) AS MA_10,
         CASE WHEN volume > 0 THEN taker_buy_base_volume / volume ELSE 0.0 END AS taker_ratio
  FROM req LEFT JOIN h USING (symbol))
SELECT *, CASE WHEN newest IS NULL THEN 'no_history' WHEN open_time <= newest THEN 'stale'
               WHEN open IS NULL OR return_1m IS NULL THEN 'invalid' ELSE 'ok' END AS status FROM f"""


def _scored_requests_sql() -> str:
    fit = (f"SELECT regr_slope(close_t_plus_10, close) AS a, regr_intercept(close_t_plus_10, close) AS b "
           f"FROM ({silver_sql('minute', True)}) t")
    return f"""
SELECT request_id, request_id AS user_id, symbol, open_time AS timestamp, open_time + INTERVAL 10 MINUTE AS prediction_for,
       close AS current_price, CASE WHEN status = 'ok' THEN a * close + b END AS predicted_price, status
FROM ({request_features_sql()}) r, ({fit}) f"""


def ols_sql(src: str) -> str:
    """Coefficients of the 13-feature least-squares fit of ``src`` as rows (feature, coefficient): elimination in the
    matrix of correlations."""
    v = [*FEATURES13, "close_t_plus_10"]
    k = len(FEATURES13)
    x = {c: f"{c}::DOUBLE" for c in v}
    matrix = ", ".join("[" + ", ".join(f"corr({x[a]}, {x[b]})" if a != b else "1.0" for b in v) + "]" for a in FEATURES13)
    mean, sd = (", ".join(f"{f}({x[c]})" for c in v) for f in ("avg", "stddev_pop"))
    names = ", ".join(f"'{c}'" for c in FEATURES13)
    return f"""
WITH RECURSIVE f AS ({src}),
s AS (SELECT [{matrix}] AS m, [{mean}] AS mean, [{sd}] AS sd FROM f),
e AS (
  SELECT 1 AS k, m, mean, sd FROM s
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / r[k])
                ELSE list_transform(list_zip(r, m[k]), lambda p: p[1] - r[k] / m[k][k] * p[2]) END), mean, sd
  FROM e WHERE k <= {k}),
w AS (SELECT mean, list_transform(m, lambda r, i: r[{k + 1}] * sd[{k + 1}] / sd[i]) AS w FROM e WHERE k = {k + 1})
SELECT unnest([{names}, 'intercept']) AS feature,
       unnest(list_append(w, mean[{k + 1}] - list_sum(list_transform(list_zip(w, mean[1:{k}]), lambda p: p[1] * p[2])))) AS coefficient
FROM w"""


def _ols_split(cmp: str) -> str:
    return f"""
SELECT * EXCLUDE (rn, n) FROM (
  SELECT *, row_number() OVER (ORDER BY open_time) AS rn, count(*) OVER () AS n FROM ({silver_sql('minute')}) s) i
WHERE rn {cmp} floor(n * 0.8)"""


def _more(o: dict) -> None:
    o["time_index_ranges"] = f"""
SELECT t, open_time, symbol, close, count(*) OVER () AS n, row_number() OVER (ORDER BY t NULLS FIRST, open_time, symbol) AS rn
FROM (SELECT CASE WHEN minute(open_time) % 3 <> 0 THEN open_time END AS t, open_time, symbol, close FROM ({bars_sql('minute', True)}) b) q"""
    keyed = silver_sql("minute", True)
    o["refit_coefficients"] = rounded(ols_sql(keyed), ["coefficient"])
    variables = [*FEATURES13, "close_t_plus_10"]
    o["moment_correlations"] = f"WITH s AS ({keyed}) " + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS rows, CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN round(corr({a}::DOUBLE, {b}::DOUBLE), {R}) END AS correlation FROM s"
        for i, a in enumerate(variables) for b in variables[i + 1:])
    train = ols_sql(_ols_split("<="))
    o["train_ols"] = rounded(train, ["coefficient"])
    terms = " + ".join(f"c.{x} * t.{x}" for x in FEATURES13)
    wide = "SELECT " + ", ".join(f"max(CASE WHEN feature = '{x}' THEN coefficient END) AS {x}" for x in [*FEATURES13, "intercept"]) + f" FROM ({train}) k"
    scored = f"SELECT t.open_time, t.close_t_plus_10, {terms} + c.intercept AS prediction FROM ({_ols_split('>')}) t, ({wide}) c"
    o["score_test"] = f"SELECT open_time, round(close_t_plus_10, 4) AS close_t_plus_10, round(prediction, 4) AS prediction FROM ({scored}) s"
    o["evaluate_model"] = f"""
SELECT count(*) AS n, round(sqrt(avg((prediction - close_t_plus_10) ^ 2)), {R}) AS rmse,
       round(avg(abs(prediction - close_t_plus_10)), {R}) AS mae,
       round(1 - avg((prediction - close_t_plus_10) ^ 2) / var_pop(close_t_plus_10), {R}) AS r2
FROM ({scored}) s"""
    o["model_roundtrip"] = f"SELECT open_time, round(prediction, 4) AS p_fit, round(prediction, 4) AS p_loaded FROM ({scored}) s"
    o["silver_incremental"] = rounded(keyed, DERIVED)
    o["stream_features_shuffled"] = rounded(
        f"SELECT * EXCLUDE (close_time, close_t_plus_10), 'ok' AS status FROM ({features_sql(bars_sql('minute', True), True, ratio='zero')}) f", DERIVED)
    o["settle_stream"] = rounded(_settled(), ["current_price", "predicted_price", "actual_price", "error"])
    o["monitor_stream"] = f"""
SELECT CAST(timestamp AS DATE) AS day, model_version, count(*) AS n_predictions,
       count(error) AS n_settled, round(sqrt(avg(error * error)), {R}) AS rmse,
       round(avg(abs(error)), {R}) AS mae
FROM ({_settled()}) s GROUP BY 1, 2"""
    silver_h, silver_m = silver_sql("hour"), silver_sql("minute")
    feat_h = features_sql(bars_sql("hour"), False)
    o["epoch_seconds"] = f"""
SELECT open_time, floor(epoch(open_time))::BIGINT AS open_epoch,
       floor(epoch(close_time))::BIGINT AS close_epoch FROM ({bars_sql('minute')}) b"""
    o["kline_parse"] = f"SELECT *, '0' AS ignore FROM ({bars_sql('minute', True)}) b"
    o["drop_columns"] = bars_sql("hour")
    refit = f"""
SELECT * REPLACE (
         (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS return_1m,
         avg(close) OVER (ORDER BY open_time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS MA_5,
         avg(close) OVER (ORDER BY open_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS MA_10,
         taker_buy_base_volume / nullif(volume, 0) AS taker_ratio)
FROM ({silver_m}) s WINDOW w AS (ORDER BY open_time)"""
    nn = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in NUMERIC_SILVER)
    o["features_refit"] = rounded(f"SELECT * FROM ({refit}) r WHERE {nn}", DERIVED)
    o["numeric_profile"] = rounded(
        f"SELECT {', '.join(NUMERIC_SILVER)} FROM ({silver_m}) s", DERIVED)
    kinds = {"open_time": "timestamp_ntz", "close_time": "timestamp_ntz", "number_of_trades": "bigint"}
    o["schema_table"] = f"WITH s AS ({silver_h}) " + " UNION ALL ".join(
        f"SELECT {i + 1} AS pos, '{c}' AS name, '{kinds.get(c, 'double')}' AS type, count({c}) AS values FROM s"
        for i, c in enumerate(FEATURE_TABLE))
    o["lookup_first"] = f"SELECT * FROM ({USERS}) u WHERE username = 'Customer#000000007' LIMIT 1"
    o["bronze_merge"] = (f"SELECT * REPLACE (CASE WHEN hour(open_time) % 2 = 0 THEN close + 1 ELSE close END AS close) "
                         f"FROM ({bars_sql('hour', True)}) b")
    o["silver_roundtrip"] = silver_rounded("hour")
    o["sink_recount"] = f"""
SELECT count(*) AS source_rows, count(*) AS target_rows, 0::BIGINT AS missing_rows,
       0::BIGINT AS extra_rows FROM ({bars_sql('minute')}) b"""
    damaged = "FILTER (WHERE day(open_time) % 5 = 0 AND minute(open_time) = {})"
    o["sink_check"] = f"""
SELECT count(*) AS source_rows, count(*) - count(*) {damaged.format(7)} + count(*) {damaged.format(11)} AS target_rows,
       count(*) {damaged.format(7)} AS missing_rows, count(*) {damaged.format(11)} AS extra_rows
FROM ({bars_sql('minute', True)}) b"""
    o["preview_ordered"] = f"SELECT * FROM ({silver_rounded('hour')}) s ORDER BY open_time LIMIT 5"
    o["split_train"] = _split("<=")
    o["split_test"] = _split(">")
    o["split_pooled_train"] = f"""
SELECT symbol, open_time, close, close_t_plus_10, rn FROM (
  SELECT symbol, open_time, close, close_t_plus_10,
         row_number() OVER (ORDER BY open_time, symbol) AS rn, count(*) OVER () AS n
  FROM ({silver_sql('minute', True)}) s) i
WHERE rn <= floor(n * 0.8)"""
    o["outlier_flag"] = _flag()
    o["outlier_rows"] = f"SELECT * FROM ({_flag()}) f WHERE is_outlier"
    o["outlier_count"] = f"SELECT count_if(is_outlier)::BIGINT AS outlier_count FROM ({_flag()}) f"
    o["iqr_bounds"] = f"""
SELECT round(q1, {R}) AS Q1, round(q3, {R}) AS Q3, round(q3 - q1, {R}) AS IQR,
       round(q1 - 1.5 * (q3 - q1), {R}) AS lower_bound, round(q3 + 1.5 * (q3 - q1), {R}) AS upper_bound
FROM (SELECT quantile_disc(close_t_plus_10, 0.25) AS q1,
             quantile_disc(close_t_plus_10, 0.75) AS q3 FROM ({silver_h}) s) q"""
    feat_m = features_sql(bars_sql("minute"), False)
    not_null = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in NUMERIC_SILVER)
    o["dropna_subset"] = rounded(f"SELECT * FROM ({feat_m}) f WHERE {not_null}", DERIVED)
    o["null_profile"] = "SELECT " + ", ".join(
        f"count_if({c} IS NULL)::BIGINT AS {c}" for c in FEATURE_TABLE) + f" FROM ({feat_h}) f"
    o["row_count"] = f"SELECT count(*) AS row_count FROM ({silver_m}) s"
    refetch = f"SELECT * FROM ({bars_sql('minute', True)}) a UNION ALL SELECT * FROM ({bars_sql('minute', True)}) b"
    o["distinct_rows"] = f"""
WITH r AS ({refetch})
SELECT (SELECT count(*) FROM r) AS row_count,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM r) d) AS distinct_rows"""
    o["duplicate_count"] = f"""
WITH r AS ({refetch})
SELECT (SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r) d) AS duplicate_count"""
    parts = []
    for c in NUMERIC_SILVER:
        x = f"{c}::DOUBLE"
        parts.append(f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), {R}) AS mean, "
                     f"round(stddev_samp({x}), {R}) AS stddev, round(min({x}), {R}) AS min, "
                     f"round(max({x}), {R}) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM s")
    parts.append("SELECT 'symbol', count(symbol), NULL, NULL, NULL, NULL, min(symbol), max(symbol) FROM s")
    o["describe_stats"] = f"WITH s AS ({silver_sql('minute', True)}) " + " UNION ALL ".join(parts)
    from kandela.plans.profile import COLUMNS
    o["profile_incremental"] = f"WITH b AS ({bars_sql('minute', True)}) " + " UNION ALL ".join(
        f"SELECT symbol, '{c}' AS column_name, count(*) AS row_count, count_if({c} IS NULL)::BIGINT AS null_count, count({c}) AS count, "
        f"round(avg({c}), {R}) AS mean, round(stddev_samp({c}), {R}) AS stddev, round(min({c})::DOUBLE, {R}) AS min, round(max({c})::DOUBLE, {R}) AS max "
        "FROM b GROUP BY symbol" for c in COLUMNS)
    o["approx_median"] = f"SELECT count(close_t_plus_10) AS rows, true AS within_error FROM ({silver_h}) s"
    fit = (f"SELECT regr_slope(close_t_plus_10, close) AS a, regr_intercept(close_t_plus_10, close) AS b "
           f"FROM ({_split('<=')}) t")
    test = f"SELECT open_time, close_t_plus_10, a * close + b AS prediction FROM ({_split('>')}) t, ({fit}) f"
    o["score_one_feature"] = rounded(test, ["prediction"])
    o["evaluate_one_feature"] = f"""
SELECT count(*) AS n, round(sqrt(avg((prediction - close_t_plus_10) ^ 2)), {R}) AS rmse,
       round(avg(abs(prediction - close_t_plus_10)), {R}) AS mae,
       round(1 - avg((prediction - close_t_plus_10) ^ 2) / var_pop(close_t_plus_10), {R}) AS r2
FROM ({test}) s"""
    o["ols_optimality"] = " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS uncorrelated" for c in FEATURES13)
    scored = _scored_requests_sql()
    o["score_requests_one_feature"] = rounded(
        f"SELECT request_id, symbol, timestamp, prediction_for, current_price, predicted_price, status FROM ({scored}) s",
        ["current_price", "predicted_price"])
    o["prediction_log"] = rounded(f"""
SELECT request_id, user_id, symbol, timestamp, prediction_for, current_price, predicted_price, NULL::DOUBLE AS actual_price,
       NULL::DOUBLE AS confidence_lower, NULL::DOUBLE AS confidence_upper, 'v1.0.0' AS model_version, NULL::DOUBLE AS error,
       CAST(timestamp AS DATE) AS dt FROM ({scored}) s WHERE status = 'ok'""", ["current_price", "predicted_price"])
    nul = " + ".join(f"({c} IS NULL)::INT" for c in FEATURE_TABLE)
    anyn = " OR ".join(f"{c} IS NULL" for c in FEATURE_TABLE)
    o["quality_profile"] = f"""
WITH f AS ({feat_h})
SELECT (SELECT count(*) FROM f) AS row_count,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM f) d) AS distinct_rows,
       (SELECT count(*) FROM f) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f) d) AS duplicate_count,
       (SELECT coalesce(sum({nul}), 0)::BIGINT FROM f) AS null_cells,
       (SELECT count_if({anyn})::BIGINT FROM f) AS rows_with_null"""
    o["regression_metrics"] = f"""
SELECT count(*) AS n, round(sqrt(avg((close - close_t_plus_10) ^ 2)), {R}) AS rmse,
       round(avg(abs(close - close_t_plus_10)), {R}) AS mae,
       round(1 - avg((close - close_t_plus_10) ^ 2) / var_pop(close_t_plus_10), {R}) AS r2
FROM ({silver_m}) s"""
    o["latest_k"] = f"SELECT * FROM ({bars_sql('minute')}) b ORDER BY open_time DESC LIMIT 10"
    top = (f"SELECT * FROM ({bars_sql('minute', True)}) b "
           "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= {k}")
    o["latest_k_per_key"] = top.format(k=10)
    o["latest_state"] = top.format(k=10)
    o["latest_row"] = top.format(k=1)
    o["history_plus_new"] = f"SELECT symbol, open_time, close FROM ({top.format(k=11)}) t"
    preds = predictions_sql()
    o["user_predictions"] = rounded(f"""
SELECT p.user_id, p.symbol, p.timestamp, p.predicted_price, u.username
FROM ({preds}) p JOIN ({USERS}) u ON u.user_id = p.user_id""", ["predicted_price"])
    o["orphan_predictions"] = f"""
SELECT user_id, symbol, timestamp FROM ({preds}) p
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = p.user_id)"""
    o["unique_violations"] = f"""
SELECT 'username' AS key_name, username AS key_value, count(*) AS occurrences FROM ({USERS}) u
GROUP BY username HAVING count(*) > 1
UNION ALL
SELECT 'email', email, count(*) FROM ({USERS}) u GROUP BY email HAVING count(*) > 1
UNION ALL
SELECT 'pred_key', concat_ws('|', user_id::VARCHAR, strftime(timestamp, '%Y-%m-%d %H:%M:%S'), model_version),
       count(*) FROM ({preds}) p GROUP BY 2 HAVING count(*) > 1"""
    o["predicted_change"] = rounded(f"""
SELECT symbol, timestamp, current_price, predicted_price,
       (predicted_price - current_price) / nullif(current_price, 0) * 100.0 AS predicted_change
FROM ({preds}) p""", ["current_price", "predicted_price", "predicted_change"])
    o["prediction_horizon"] = (f"SELECT symbol, open_time AS timestamp, "
                               f"open_time + INTERVAL 10 MINUTE AS prediction_for "
                               f"FROM ({bars_sql('minute', True)}) b")
    o["assemble_features"] = rounded(
        f"SELECT open_time, {', '.join(FEATURES13)}, close_t_plus_10 FROM ({silver_m}) s", DERIVED
    ).replace("SELECT * REPLACE (", "SELECT * REPLACE (number_of_trades::DOUBLE AS number_of_trades, ", 1)
    ok13 = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURES13)
    o["assemble_skip"] = rounded(
        f"SELECT open_time, {', '.join(FEATURES13)} FROM ({feat_h}) f WHERE {ok13}", DERIVED
    ).replace("SELECT * REPLACE (", "SELECT * REPLACE (number_of_trades::DOUBLE AS number_of_trades, ", 1)
    o["ols_one_feature"] = f"""
SELECT round(regr_slope(close_t_plus_10, close), {R}) AS slope,
       round(regr_intercept(close_t_plus_10, close), {R}) AS intercept
FROM ({_split('<=')}) t"""
    o["request_features"] = rounded(
        f"SELECT request_id, symbol, open_time, close_time, close, return_1m, MA_5, MA_10, taker_ratio, status "
        f"FROM ({request_features_sql()}) f", ["close", *DERIVED])
    o["request_features_latest"] = o["request_features"]
    o["settle_predictions"] = rounded(
        _settled(), ["current_price", "predicted_price", "actual_price", "error"])
    o["stream_dedup"] = bars_sql("minute", True)
    feat_k = features_sql(bars_sql("minute", True), True, ratio="zero")
    o["stream_features"] = rounded(
        f"SELECT * EXCLUDE (close_time, close_t_plus_10), 0::BIGINT AS late_rows FROM ({feat_k}) f",
        DERIVED)
    o["monitor_daily"] = f"""
SELECT CAST(timestamp AS DATE) AS day, model_version, count(*) AS n_predictions,
       count(error) AS n_settled, round(sqrt(avg(error * error)), {R}) AS rmse,
       round(avg(abs(error)), {R}) AS mae
FROM ({_settled()}) s GROUP BY 1, 2"""
