"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per key.

derives from them), so its work grows with the data. Computed doubles are
rounded to 6 decimals to compare with the DuckDB oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kandela.functions.scalar import (epoch_seconds, horizon_time, predicted_change_pct,
                                      taker_ratio)
from kandela.operators import quality as Q
from kandela.operators import relations as J
from kandela.operators import topk as T
from kandela.operators.features import add_features, numeric_columns
from kandela.operators.ordered import time_index
from kandela.operators.split import chronological_split
from kandela.plans import fixtures as fx
from kandela.plans import model as M
from kandela.plans.common import round_doubles
from kandela.plans.settlement import monitor_daily, settle
from kandela.plans.silver import build_silver
from kandela.schema import LABEL
from kandela.session import pin_utc, scratch_path
from kandela.sources import payload as PL
from kandela.sources import sinks as SK

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


# ---------------------------------------------------------------- features
@query("silver_features")
def q_silver_features(spark, sf_dir):
    """M-1 flagship: hourly bars of all events -> features -> null drop."""
    return round_doubles(build_silver(fx.bronze(spark, sf_dir, fx.HOUR), **fx.edges(fx.HOUR)))


@query("features_halo")
def q_features_halo(spark, sf_dir):
    """W-6: keyed minute series through halo blocks of 1000 rows."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return round_doubles(build_silver(b, keys=["symbol"], block_rows=1000))


@query("features_edges")
def q_features_edges(spark, sf_dir):
    """W-6, one-exchange form: keyed minute series, windows inside (symbol,
    day) with the edge rows fixed through the halo path."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return round_doubles(build_silver(b, keys=["symbol"], method="edges", bucket_unit="day",
                                      block_rows=1000))


def _hour_features(spark, sf_dir):
    return add_features(fx.bronze(spark, sf_dir, fx.HOUR), **fx.edges(fx.HOUR))


@query("target_lead10")
def q_target_lead10(spark, sf_dir):
    """W-1: close ten rows ahead."""
    return _hour_features(spark, sf_dir).select("open_time", "close", "close_t_plus_10")


@query("return_1m")
def q_return_1m(spark, sf_dir):
    """W-2: one-step return, NULL on a zero previous close."""
    return round_doubles(_hour_features(spark, sf_dir).select("open_time", "close", "return_1m"))


@query("moving_averages")
def q_moving_averages(spark, sf_dir):
    """W-3/W-4: trailing ROWS averages of 5 and 10 closes."""
    return round_doubles(_hour_features(spark, sf_dir).select("open_time", "close", "MA_5", "MA_10"))


@query("taker_ratio")
def q_taker_ratio(spark, sf_dir):
    """X-1: taker share, NULL on zero volume."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE)
    return round_doubles(b.select("open_time", "volume", "taker_buy_base_volume",
                                  taker_ratio(on_zero="null").alias("taker_ratio")))


@query("taker_ratio_guarded")
def q_taker_ratio_guarded(spark, sf_dir):
    """X-2/F-6: taker share, 0.0 unless volume > 0 (serving rule)."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE)
    return round_doubles(b.select("open_time", "volume", "taker_buy_base_volume",
                                  taker_ratio(on_zero="zero").alias("taker_ratio")))


@query("time_index")
def q_time_index(spark, sf_dir):
    """W-5: per-symbol row_number by time, without a single-partition exchange."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return time_index(b.select("symbol", "open_time", "close"), ["open_time"], ["symbol"])


@query("time_index_ranges")
def q_time_index_ranges(spark, sf_dir):
    """W-5/W-6 by sampled ranges: one series of all symbols in which a third of the rows has no time."""
    from kandela.operators.ordered import range_index
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    t = F.when(F.minute("open_time") % 3 != 0, F.col("open_time")).alias("t")
    return range_index(b.select(t, "open_time", "symbol", "close"), ["t", "open_time", "symbol"], total_col="n")


# ---------------------------------------------------------------- scans
@query("scan_bars")
def q_scan_bars(spark, sf_dir):
    """S-2: minute candles written as a partitioned bronze table and scanned with
    its fixed schema."""
    from kandela.sources.tables import load_bars
    path = scratch_path(spark, "bronze")
    SK.write_bronze(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), path)
    return load_bars(spark, path, keys=["symbol", "dt"])


@query("project_bars")
def q_project_bars(spark, sf_dir):
    """P-1/P-5: history projection with times as epoch seconds."""
    b = fx.bronze(spark, sf_dir, fx.HOUR)
    return b.select(epoch_seconds("open_time").alias("open_time"), "open", "high", "low",
                    "close", "volume", epoch_seconds("close_time").alias("close_time"),
                    "quote_asset_volume", "number_of_trades", "taker_buy_base_volume",
                    "taker_buy_quote_volume")


def _silver_h(spark, sf_dir):
    return build_silver(fx.bronze(spark, sf_dir, fx.HOUR), **fx.edges(fx.HOUR))


def _silver_m(spark, sf_dir):
    """Silver of minute candles: grows with the ticks, where hours do not."""
    return build_silver(fx.bronze(spark, sf_dir, fx.MINUTE), **fx.edges(fx.MINUTE))


@query("epoch_seconds")
def q_epoch_seconds(spark, sf_dir):
    """P-5: open/close time as epoch seconds (minute bars)."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE)
    return b.select("open_time", epoch_seconds("open_time").alias("open_epoch"),
                    epoch_seconds("close_time").alias("close_epoch"))


@query("kline_parse")
def q_kline_parse(spark, sf_dir):
    """S-1/P-2..P-4: keyed minute candles -> hourly JSON payloads -> parsed rows."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return PL.parse_klines(PL.to_payloads(b, ["symbol"], per="hour"), keep=["symbol"])


@query("drop_columns")
def q_drop_columns(spark, sf_dir):
    """P-6: parsed hourly klines without the unused ``ignore`` field."""
    b = fx.bronze(spark, sf_dir, fx.HOUR)
    return PL.parse_klines(PL.to_payloads(b, per="day")).drop("ignore")


@query("features_refit")
def q_features_refit(spark, sf_dir):
    """M-1 (training-job form, G5): return, MAs and ratio recomputed on silver,
    then rows with a NULL/NaN numeric feature or label dropped."""
    from kandela.operators.features import refit_features
    return round_doubles(refit_features(_silver_m(spark, sf_dir), **fx.edges(fx.MINUTE)))


@query("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    """P-8/M-2: silver restricted to its numeric feature columns + label."""
    s = _silver_m(spark, sf_dir)
    return round_doubles(s.select(*numeric_columns(s), LABEL))


@query("schema_table")
def q_schema_table(spark, sf_dir):
    """P-9: (pos, name, type, values) of each silver column, with the number of
    values that the scanned table has there."""
    s = _silver_h(spark, sf_dir)
    wide = s.agg(*[F.struct(F.lit(i + 1).alias("pos"), F.lit(c).alias("name"), F.lit(t).alias("type"),
                            F.count(c).alias("values")).alias(c) for i, (c, t) in enumerate(s.dtypes)])
    return wide.select(F.inline(F.array(*s.columns)))


@query("lookup_first")
def q_lookup_first(spark, sf_dir):
    """S-7: first user row with a given username (unique key)."""
    return J.lookup_first(fx.users(spark, sf_dir), "username", "Customer#000000007")


# ---------------------------------------------------------------- sinks
@query("bronze_merge")
def q_bronze_merge(spark, sf_dir):
    """K-1: two overlapping fetches of keyed hourly candles merged on
    (symbol, open_time), latest fetch winning: the second has other closes for
    every other hour and lacks the rest."""
    b = fx.bronze(spark, sf_dir, fx.HOUR, keyed=True)
    second = b.filter(F.hour("open_time") % 2 == 0).withColumn("close", F.col("close") + 1)
    return SK.merge_bronze(b.withColumn("_fetch", F.lit(1)), second.withColumn("_fetch", F.lit(2)))


@query("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    """K-2: silver written as Parquet (partitioned by day) and read back."""
    s = round_doubles(_silver_h(spark, sf_dir))
    path = scratch_path(spark, "silver")
    s.withColumn("dt", F.to_date("open_time")).write.mode("overwrite").partitionBy("dt") \
        .parquet(path)
    return spark.read.parquet(path).select(*s.columns)


@query("sink_recount")
def q_sink_recount(spark, sf_dir):
    """K-5: write minute candles, read back, compare counts and contents."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE)
    path = scratch_path(spark, "recount")
    back = SK.roundtrip(b, path)
    return SK.write_check(fx.bronze(spark, sf_dir, fx.MINUTE), back)


@query("sink_check")
def q_sink_check(spark, sf_dir):
    """K-5 by digests: keyed minute candles written by symbol and day; in the table every fifth day lacks the candles
    of minute 7 and has those of minute 11 twice. Only these days' rows are compared one by one."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    good, bad = scratch_path(spark, "bronze"), scratch_path(spark, "damaged")
    SK.write_bronze(b, good)
    fifth = F.dayofmonth("open_time") % 5 == 0
    lost = b.filter(~(fifth & (F.minute("open_time") == 7)))
    SK.write_bronze(lost.unionAll(b.filter(fifth & (F.minute("open_time") == 11))), bad)
    from kandela.sources.tables import load_bars
    read = lambda path: load_bars(spark, path, keys=["symbol", "dt"])
    return SK.check_partitions(read(good), read(bad))


@query("silver_incremental")
def q_silver_incremental(spark, sf_dir):
    """M-1/K-2: silver that follows the landing of keyed minute candles in three fetches, each of every third day;
    after each only the touched partitions and their neighbours are rebuilt."""
    from kandela.plans.silver import SILVER, follow_landing
    from kandela.sources.tables import load_bars
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True).withColumn("fetched_at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for k in (2, 0, 1):
        SK.land_candles(b.filter(F.dayofyear("open_time") % 3 == k), bronze)
        follow_landing(spark, bronze, silver, **fx.edges(fx.MINUTE))
    return round_doubles(load_bars(spark, silver, SILVER, ["symbol"]))


@query("preview_ordered")
def q_preview_ordered(spark, sf_dir):
    """K-8: the first five silver rows in time order."""
    return round_doubles(T.preview(_silver_h(spark, sf_dir), 5))


# ---------------------------------------------------------------- filters / quality
@query("split_train")
def q_split_train(spark, sf_dir):
    """F-1/M-4: earliest floor(0.8 n) silver rows."""
    s = _silver_m(spark, sf_dir).select("open_time", "close", LABEL)
    tr, _ = chronological_split(s, 0.8, keep_index=True)
    return tr


@query("split_test")
def q_split_test(spark, sf_dir):
    """F-1/M-4: the remaining silver rows."""
    s = _silver_m(spark, sf_dir).select("open_time", "close", LABEL)
    _, te = chronological_split(s, 0.8, keep_index=True)
    return te


@query("split_pooled_train")
def q_split_pooled_train(spark, sf_dir):
    """M-4/M-8: one cut through all series by time: the earliest floor(0.8 n) of
    all keyed silver rows."""
    from kandela.operators.split import pooled_split
    s = build_silver(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], **fx.edges(fx.MINUTE))
    tr, _ = pooled_split(s.select("symbol", "open_time", "close", LABEL), 0.8, keep_index=True)
    return tr


@query("outlier_flag")
def q_outlier_flag(spark, sf_dir):
    """F-3: IQR flag on the target (fences from percentile_approx)."""
    s = _silver_h(spark, sf_dir).select("open_time", LABEL)
    return Q.flag_outliers(s, LABEL)


@query("outlier_rows")
def q_outlier_rows(spark, sf_dir):
    """F-2: only the flagged rows."""
    s = _silver_h(spark, sf_dir).select("open_time", LABEL)
    return Q.outlier_rows(s, LABEL)


@query("outlier_count")
def q_outlier_count(spark, sf_dir):
    """M-10: number of flagged rows."""
    return Q.outlier_count(_silver_h(spark, sf_dir), LABEL)


@query("iqr_bounds")
def q_iqr_bounds(spark, sf_dir):
    """A-5/X-6: Q1, Q3, IQR, fences of the target."""
    return round_doubles(Q.iqr_bounds(_silver_h(spark, sf_dir), LABEL))


@query("approx_median")
def q_approx_median(spark, sf_dir):
    """A-6: median of the target with relative error 0.1: whether its rank lies
    within that error of the middle."""
    s = _silver_h(spark, sf_dir).select(LABEL)
    median = Q.approx_median(s, LABEL, 0.1).scalar()
    m = s.select(LABEL, median.alias("m"))
    below, most = F.count_if(F.col(LABEL) < F.col("m")), F.count_if(F.col(LABEL) <= F.col("m"))
    n = F.count(LABEL)
    return m.agg(n.alias("rows"), ((below <= 0.6 * n) & (most >= 0.4 * n)).alias("within_error"))


@query("dropna_subset")
def q_dropna_subset(spark, sf_dir):
    """F-4: minute features, rows with NULL/NaN in any numeric column or the
    label dropped (the training job's rule)."""
    f = add_features(fx.bronze(spark, sf_dir, fx.MINUTE), **fx.edges(fx.MINUTE))
    return round_doubles(f.na.drop(subset=numeric_columns(f) + [LABEL]))


@query("null_profile")
def q_null_profile(spark, sf_dir):
    """A-2/F-5: NULL count per column of the hourly feature table."""
    return Q.null_profile(_hour_features(spark, sf_dir))


@query("row_count")
def q_row_count(spark, sf_dir):
    """A-1: silver row count."""
    return Q.row_count(_silver_m(spark, sf_dir))


@query("distinct_rows")
def q_distinct_rows(spark, sf_dir):
    """A-3: rows and distinct rows of two overlapping fetches."""
    return Q.distinct_profile(fx.refetched(spark, sf_dir)).select("row_count", "distinct_rows")


@query("duplicate_count")
def q_duplicate_count(spark, sf_dir):
    """A-3: duplicate rows of two overlapping fetches."""
    return Q.distinct_profile(fx.refetched(spark, sf_dir)).select("duplicate_count")


@query("describe_stats")
def q_describe_stats(spark, sf_dir):
    """A-4: count/mean/stddev/min/max per numeric and text column of keyed
    minute silver."""
    s = build_silver(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], **fx.edges(fx.MINUTE))
    return round_doubles(Q.describe_long(s))


@query("profile_incremental")
def q_profile_incremental(spark, sf_dir):
    """A-2/A-4/M-11 from day states that follow the landing of keyed minute candles in three fetches: counts, mean,
    deviation and extremes of each symbol's columns (quantiles are tested by their ranks)."""
    from kandela.plans import profile as P
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True).withColumn("fetched_at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    bronze, kept = scratch_path(spark, "bronze"), scratch_path(spark, "states")
    for k in (2, 0, 1):
        SK.land_candles(b.filter(F.dayofyear("open_time") % 3 == k), bronze)
        P.follow_landing(spark, bronze, kept)
    out = P.profile(P.read_states(spark, kept), ["symbol"])
    return round_doubles(out.select("symbol", "column_name", "row_count", "null_count", "count", "mean", "stddev", "min", "max"))


@query("quality_profile")
def q_quality_profile(spark, sf_dir):
    """M-11: one-row quality summary of the feature table."""
    return Q.quality_profile(_hour_features(spark, sf_dir))


@query("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    """A-7..A-9: RMSE, MAE, R^2 of the naive predictor (close) on silver."""
    s = _silver_m(spark, sf_dir).withColumn("prediction", F.col("close"))
    return round_doubles(M.regression_metrics(s))


# ---------------------------------------------------------------- top-k / union
@query("latest_k")
def q_latest_k(spark, sf_dir):
    """T-1/T-3: the ten newest minute candles, ascending."""
    return T.latest_k(fx.bronze(spark, sf_dir, fx.MINUTE), 10)


@query("latest_k_per_key")
def q_latest_k_per_key(spark, sf_dir):
    """T-1: the ten newest minute candles of every symbol."""
    return T.latest_k_per_key(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], 10)


@query("latest_state")
def q_latest_state(spark, sf_dir):
    """M-9/T-1: the maintained table of each symbol's newest 10 candles, after three fetches, each of every third day."""
    from kandela.plans.latest import follow_landing, read_latest
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True).withColumn("fetched_at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    bronze, latest = scratch_path(spark, "bronze"), scratch_path(spark, "latest")
    for k in (2, 0, 1):
        SK.land_candles(b.filter(F.dayofyear("open_time") % 3 == k), bronze)
        follow_landing(spark, bronze, latest)
    return read_latest(spark, latest)


@query("latest_row")
def q_latest_row(spark, sf_dir):
    """T-2: the newest minute candle of every symbol."""
    return T.latest_row(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"])


@query("history_plus_new")
def q_history_plus_new(spark, sf_dir):
    """U-1: ten newest candles of each symbol plus the request candle."""
    hist, req = fx.requests(spark, sf_dir)
    h = T.latest_k_per_key(hist, ["symbol"], 10).select("symbol", "open_time", "close")
    r = req.select("symbol", F.col("requested_at").alias("open_time"),
                   F.col("close_price").alias("close"))
    return T.append_rows(h, r)


# ---------------------------------------------------------------- relations
@query("user_predictions")
def q_user_predictions(spark, sf_dir):
    """J-1: prediction log joined to users."""
    p = fx.predictions(spark, sf_dir).select("user_id", "symbol", "timestamp", "predicted_price")
    return round_doubles(J.user_predictions(p, fx.users(spark, sf_dir)))


@query("orphan_predictions")
def q_orphan_predictions(spark, sf_dir):
    """J-2: predictions whose user was deleted."""
    p = fx.predictions(spark, sf_dir).select("user_id", "symbol", "timestamp")
    return J.orphan_predictions(p, fx.active_users(spark, sf_dir))


@query("unique_violations")
def q_unique_violations(spark, sf_dir):
    """J-3: duplicated usernames / emails / (user, time, version) keys."""
    u = J.unique_violations(fx.users(spark, sf_dir), ["username", "email"])
    p = fx.predictions(spark, sf_dir).withColumn(
        "pred_key", F.concat_ws("|", F.col("user_id").cast("string"),
                                F.col("timestamp").cast("string"), "model_version"))
    return u.unionByName(J.unique_violations(p, ["pred_key"]))


# ---------------------------------------------------------------- scalar
@query("predicted_change")
def q_predicted_change(spark, sf_dir):
    """X-3: predicted move in percent."""
    p = fx.predictions(spark, sf_dir)
    return round_doubles(p.select("symbol", "timestamp", "current_price", "predicted_price",
                                  predicted_change_pct().alias("predicted_change")))


@query("prediction_horizon")
def q_prediction_horizon(spark, sf_dir):
    """X-4: timestamp + 10 minutes."""
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return b.select("symbol", F.col("open_time").alias("timestamp"),
                    horizon_time("open_time", 10).alias("prediction_for"))


# ---------------------------------------------------------------- model
@query("assemble_features")
def q_assemble_features(spark, sf_dir):
    """M-3: the 13-feature vector, flattened back to columns."""
    frame = M.ml_frame(_silver_m(spark, sf_dir))
    return round_doubles(M.flatten_features(frame))


@query("assemble_skip")
def q_assemble_skip(spark, sf_dir):
    """F-7: assembling the unfiltered feature table with handleInvalid=skip."""
    f = _hour_features(spark, sf_dir)
    return round_doubles(M.flatten_features(M.assemble(f, handle_invalid="skip")
                                            .select("open_time", "features")))


def _split_m(spark, sf_dir):
    frame = M.ml_frame(_silver_m(spark, sf_dir))
    return chronological_split(frame, 0.8)


@query("ols_one_feature")
def q_ols_one_feature(spark, sf_dir):
    """M-5: LinearRegression of the target on close over the training split."""
    s = _silver_m(spark, sf_dir)
    tr, _ = chronological_split(M.assemble(s, ["close"]).select("open_time", "features", LABEL),
                                0.8)
    m = M.fit_linear(tr)
    return round_doubles(spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))],
                                               "slope double, intercept double"))


def _one_feature(spark, sf_dir):
    """(model of the target on close, test rows) of the hourly training split."""
    frame = M.assemble(_silver_m(spark, sf_dir), ["close"]).select("open_time", "features", LABEL)
    tr, te = chronological_split(frame, 0.8)
    return M.fit_linear(tr), te


@query("score_one_feature")
def q_score_one_feature(spark, sf_dir):
    """M-6/S-5/K-6: test rows scored by the saved and loaded one-feature model."""
    m, te = _one_feature(spark, sf_dir)
    path = scratch_path(spark, "model")
    M.save_model(m, path)
    return round_doubles(M.score(M.load_model(path), te).select("open_time", LABEL, "prediction"))


@query("evaluate_one_feature")
def q_evaluate_one_feature(spark, sf_dir):
    """M-7: metrics of the one-feature model on the test split."""
    m, te = _one_feature(spark, sf_dir)
    return round_doubles(M.evaluate(m, te)[0])


@query("ols_optimality")
def q_ols_optimality(spark, sf_dir):
    """M-5: the 13-feature fit is the least-squares one: on its training rows the
    residuals are uncorrelated with every feature (0 at 4 decimals)."""
    from pyspark.ml.functions import vector_to_array
    from kandela.schema import FEATURE_COLUMNS
    tr, _ = _split_m(spark, sf_dir)
    r = M.score(M.fit_linear(tr), tr).select((F.col(LABEL) - F.col("prediction")).alias("r"), vector_to_array("features").alias("x"))
    wide = r.agg(*[F.abs(F.corr("r", F.col("x")[i])).alias(c) for i, c in enumerate(FEATURE_COLUMNS)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), (F.round(F.col(c), 4) == 0).alias("uncorrelated")) for c in FEATURE_COLUMNS])
    return wide.select(F.inline(rows))


def _day_sums(spark, sf_dir):
    """Day sums of keyed minute silver, from two updates of their table: every other day first."""
    from kandela.plans import moments
    s = build_silver(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], **fx.edges(fx.MINUTE))
    s = s.withColumn("dt", F.to_date("open_time"))
    path = scratch_path(spark, "moments")
    moments.update(s.filter(F.dayofyear("dt") % 2 == 0), path)
    moments.update(s, path)
    return path


@query("refit_coefficients")
def q_refit_coefficients(spark, sf_dir):
    """M-5/M-8: the 13-feature fit of keyed silver from mergeable day sums."""
    from kandela.plans import moments
    return round_doubles(M.coefficients_frame(spark, moments.refit(spark, _day_sums(spark, sf_dir))))


@query("moment_correlations")
def q_moment_correlations(spark, sf_dir):
    """M-5: correlations of the 14 variables, from the merged day sums."""
    from kandela.plans import moments
    path = _day_sums(spark, sf_dir)
    t = moments.table(moments.read(spark, path))
    one = t.filter("b = 'one'").select(F.col("a").alias("v"), F.col("value").alias("s"))
    n = t.filter("a = 'one'").select(F.col("value").alias("n"))
    own = t.filter("a = b and a <> 'one'").select(F.col("a").alias("w"), F.col("value").alias("q"))
    own = own.join(one, F.col("w") == F.col("v")).crossJoin(n).select("w", "s", "n", F.sqrt(F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))).alias("d"))
    left, right = (own.select(F.col("w").alias(c), F.col("s").alias(f"s{c}"), F.col("d").alias(f"d{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
    out = t.filter("b <> 'one' and a <> b").join(left, "a").join(right, "b")
    # a variable that is always the same has no correlation
    corr = F.try_divide(F.col("value") - F.col("sa") * F.col("sb") / F.col("na"), F.nullif(F.round(F.col("da") * F.col("db"), 9), F.lit(0.0)))
    return round_doubles(out.select("a", "b", F.col("na").cast("long").alias("rows"), corr.alias("correlation")))


@query("train_ols")
def q_train_ols(spark, sf_dir):
    """M-5: the 13-feature model's coefficients."""
    tr, _ = _split_m(spark, sf_dir)
    return round_doubles(M.coefficients_frame(spark, M.fit_linear(tr)))


@query("score_test")
def q_score_test(spark, sf_dir):
    """M-6: test rows with predictions."""
    tr, te = _split_m(spark, sf_dir)
    return round_doubles(M.score(M.fit_linear(tr), te).select("open_time", LABEL, "prediction"), 4)


@query("evaluate_model")
def q_evaluate_model(spark, sf_dir):
    """M-7: RMSE/MAE/R^2 on the test split."""
    tr, te = _split_m(spark, sf_dir)
    metrics, _ = M.evaluate(M.fit_linear(tr), te)
    return round_doubles(metrics)


@query("train_job")
def q_train_job(spark, sf_dir):
    """M-8: whole training job (keyed minute candles, DAG feature refit)."""
    from kandela.plans.training import run_training
    s = build_silver(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], **fx.edges(fx.MINUTE))
    res = run_training(s, ["symbol"], refit=True, model_path=scratch_path(spark, "model"),
                       **fx.edges(fx.MINUTE))
    return res.metrics


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """S-5/K-6: save, load, and score with the loaded model."""
    tr, te = _split_m(spark, sf_dir)
    m = M.fit_linear(tr)
    path = scratch_path(spark, "model")
    M.save_model(m, path)
    back = M.load_model(path)
    a = M.score(m, te).select("open_time", F.col("prediction").alias("p_fit"))
    b = M.score(back, te).select("open_time", F.col("prediction").alias("p_loaded"))
    return round_doubles(a.join(b, "open_time"), 4)


# ---------------------------------------------------------------- scoring / log
def _score(spark, sf_dir, features=None):
    from kandela.plans.scoring import score_candidates
    from kandela.plans.training import run_training
    hist, req = fx.request_batch(spark, sf_dir)
    s = build_silver(hist, ["symbol"], **fx.edges(fx.MINUTE))
    if features:
        model = M.fit_linear(M.assemble(s, features).select("features", LABEL))
        return score_candidates(hist, req, model, features=features)
    return score_candidates(hist, req, run_training(s, ["symbol"]).model)


@query("score_requests")
def q_score_requests(spark, sf_dir):
    """M-9: set-based scoring: a row with its status for every request."""
    return _score(spark, sf_dir).drop("created_at", "updated_at")


@query("score_requests_one_feature")
def q_score_requests_one_feature(spark, sf_dir):
    """M-9: the same with a model of close alone, whose predictions SQL can give."""
    return round_doubles(_score(spark, sf_dir, ["close"]).select(
        "request_id", "symbol", "timestamp", "prediction_for", "current_price", "predicted_price", "status"))


@query("request_features")
def q_request_features(spark, sf_dir):
    """M-9 feature part: serving features and status of each request (X-5: its
    close time is open time + 60 s)."""
    from kandela.plans.scoring import request_features
    hist, req = fx.request_batch(spark, sf_dir)
    return round_doubles(request_features(hist, req).select(
        "request_id", "symbol", "open_time", "close_time", "close", "return_1m", "MA_5", "MA_10", "taker_ratio", "status"))


@query("request_features_latest")
def q_request_features_latest(spark, sf_dir):
    """M-9: the same features from the maintained table of newest candles; the history isn't read for them."""
    from kandela.plans.latest import read_latest, update_latest
    from kandela.plans.scoring import request_features
    hist, req = fx.request_batch(spark, sf_dir)
    latest = scratch_path(spark, "latest")
    update_latest(hist.withColumn("dt", F.to_date("open_time")), latest)
    return round_doubles(request_features(read_latest(spark, latest), req).select(
        "request_id", "symbol", "open_time", "close_time", "close", "return_1m", "MA_5", "MA_10", "taker_ratio", "status"))


@query("prediction_log")
def q_prediction_log(spark, sf_dir):
    """K-7: scored requests added to the Parquet log, twice, and read back: the
    second time adds nothing. Predictions are those of the one-feature model."""
    from kandela.plans.scoring import append_predictions, read_predictions
    path = scratch_path(spark, "predlog")
    scored = _score(spark, sf_dir, ["close"])
    append_predictions(scored, path)
    append_predictions(scored, path)
    return round_doubles(read_predictions(spark, path).drop("created_at", "updated_at"))


@query("settle_predictions")
def q_settle_predictions(spark, sf_dir):
    """R-5: fill actual_price / error from the candle at the horizon."""
    p = fx.predictions(spark, sf_dir)
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return round_doubles(settle(p, b))


@query("monitor_daily")
def q_monitor_daily(spark, sf_dir):
    """R-6: daily RMSE/MAE per model version over settled predictions."""
    p = fx.predictions(spark, sf_dir)
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    return round_doubles(monitor_daily(settle(p, b)))


# ---------------------------------------------------------------- streaming
def _land_days_in_order(bars: DataFrame, path: str) -> None:
    """Land candle files one day after the other, as a fetcher would: the file
    stream then reads them in time order (file modification order). One small
    write per day of the fixture's range."""
    d = bars.withColumn("dt", F.to_date("open_time"))
    days = [r[0] for r in d.select("dt").distinct().orderBy("dt").collect()]
    for day in days:
        d.filter(F.col("dt") == F.lit(day)).coalesce(1).write.mode("append") \
            .partitionBy("dt").parquet(path)


def _payload_dir(spark, sf_dir, per="day"):
    """Payload files of keyed minute candles, written twice (two overlapping
    fetches), in a fresh folder under the shared checkpoint folder."""
    from kandela.streaming.ingest import write_payload_files
    docs = PL.to_payloads(fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True), ["symbol"], per=per)
    src = scratch_path(spark, "payloads")
    write_payload_files(docs, src)
    write_payload_files(docs, src)
    return src


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """R-1/R-2: payload files of two overlapping fetches landed by Structured
    Streaming (availableNow), closed candles only, in several micro-batches."""
    from kandela.sources.tables import load_bars
    from kandela.streaming.ingest import land_bronze
    src = _payload_dir(spark, sf_dir)
    out, ck = scratch_path(spark, "landed"), scratch_path(spark, "landed-ck")
    land_bronze(spark, src, out, ck, max_files_per_trigger=200).awaitTermination()
    return load_bars(spark, out, keys=["symbol"])


@query("stream_features")
def q_stream_features(spark, sf_dir):
    """R-3: online per-symbol features from a stream of candle files (state
    holds the last nine closes); equals the batch features."""
    from kandela.streaming.online import online_features
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    src = scratch_path(spark, "bars")
    _land_days_in_order(b, src)
    stream = spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 8).parquet(src)
    out, ck = scratch_path(spark, "online"), scratch_path(spark, "online-ck")
    (online_features(stream).writeStream.format("parquet").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(out).awaitTermination())
    return round_doubles(spark.read.schema(
        "symbol string, open_time timestamp_ntz, open double, high double, low double, "
        "close double, volume double, quote_asset_volume double, number_of_trades bigint, "
        "taker_buy_base_volume double, taker_buy_quote_volume double, return_1m double, "
        "MA_5 double, MA_10 double, taker_ratio double, late_rows bigint").parquet(out))


def _late_marker(spark, like: DataFrame, times: list[str], path: str) -> None:
    """One row of the symbol ``~`` far ahead of all others, as the last file of a stream: it moves the watermark."""
    first = like.agg(*[F.max(c).alias(c) for c in like.columns])
    far = {c: (F.col(c) + F.expr("INTERVAL 2000 DAYS")) for c in times}
    first.withColumns({**far, "symbol": F.lit("~")}).select(*like.columns).coalesce(1).write.mode("append").parquet(path)


@query("stream_features_shuffled")
def q_stream_features_shuffled(spark, sf_dir):
    """R-3 in event time: candle files in no order at all, several micro-batches; every candle comes out once."""
    from kandela.streaming import event_time
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    src = scratch_path(spark, "bars")
    b.repartition(12, F.xxhash64("symbol", "open_time")).write.parquet(src)
    _late_marker(spark, b, ["open_time", "close_time"], src)
    stream = spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 5).parquet(src)
    out, ck = scratch_path(spark, "ordered"), scratch_path(spark, "ordered-ck")
    writer = event_time.ordered_features(stream, "1000 days").writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True)
    event_time.start(writer, spark, out).awaitTermination()
    return round_doubles(spark.read.schema(event_time.OUTPUT).parquet(out).filter("symbol <> '~'"))


@query("settle_stream")
def q_settle_stream(spark, sf_dir):
    """R-5 as a stream-stream join: predictions and candles from files, several micro-batches; what never settles
    comes out without a price."""
    from kandela.streaming.settlement import start_settling
    p, b = fx.predictions(spark, sf_dir), fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    sources = []
    for name, df, times in (("preds", p, ["timestamp", "prediction_for"]), ("bars", b, ["open_time", "close_time"])):
        src = scratch_path(spark, name)
        df.repartition(6, F.xxhash64("symbol", times[0])).write.parquet(src)
        _late_marker(spark, df, times, src)
        sources.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(src))
    out, ck = scratch_path(spark, "settled"), scratch_path(spark, "settled-ck")
    start_settling(*sources, out, ck, delay="1000 days").awaitTermination()
    return round_doubles(spark.read.schema(p.schema).parquet(out).filter("symbol <> '~'"))


@query("monitor_stream")
def q_monitor_stream(spark, sf_dir):
    """R-6 as a stream: day figures kept up to date over several micro-batches of settled predictions."""
    from kandela.streaming.settlement import read_monitor, start_monitor
    s = settle(fx.predictions(spark, sf_dir), fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True))
    src, out, ck = (scratch_path(spark, n) for n in ("settled", "monitor", "monitor-ck"))
    s.repartition(4, F.xxhash64("symbol", "timestamp")).write.parquet(src)
    start_monitor(spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 2).parquet(src), out, ck).awaitTermination()
    return round_doubles(read_monitor(spark, out))


@query("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """R-4: online features streamed from candle files, scored per micro-batch
    by foreachBatch into a batch-id-keyed (idempotent) prediction log."""
    from kandela.plans.training import run_training
    from kandela.streaming.online import online_features
    from kandela.streaming.scoring import start_scoring
    b = fx.bronze(spark, sf_dir, fx.MINUTE, keyed=True)
    model = run_training(build_silver(b, ["symbol"], **fx.edges(fx.MINUTE)), ["symbol"]).model
    src = scratch_path(spark, "bars")
    _land_days_in_order(b, src)
    feats = online_features(spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 8)
                            .parquet(src))
    log, ck = scratch_path(spark, "stream-log"), scratch_path(spark, "stream-log-ck")
    start_scoring(feats, model, log, ck).awaitTermination()
    return spark.read.parquet(log).drop("created_at", "updated_at")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["silver_features"](spark, sf_dir)

