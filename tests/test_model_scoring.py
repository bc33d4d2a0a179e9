"""Model (M-3..M-8, F-7), scoring (M-9, E11), settlement (R-5, R-6)."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, bar_rows, bars_df
from kandela.operators.features import silver
from kandela.operators.split import chronological_split
from kandela.plans import fixtures as fx
from kandela.plans import model as M
from kandela.plans.scoring import request_features, score_candidates
from kandela.plans.settlement import monitor_daily, settle
from kandela.plans.training import run_training
from kandela.schema import FEATURE_COLUMNS, LABEL


@pytest.fixture(scope="module")
def silver_h(spark):
    return silver(fx.bronze(spark, SF_SMALL, fx.HOUR)).cache()


def test_coefficients_match_numpy(spark, silver_h):
    cols = ["close", "volume", "MA_5"]
    tr, _ = chronological_split(M.ml_frame(silver_h, cols), 0.8)
    m = M.fit_linear(tr)
    pdf = silver_h.select("open_time", *cols, LABEL).toPandas().sort_values("open_time")
    n = int(len(pdf) * 0.8)
    X = np.column_stack([pdf[cols].to_numpy()[:n], np.ones(n)])
    beta = np.linalg.lstsq(X, pdf[LABEL].to_numpy()[:n], rcond=None)[0]
    assert np.allclose(m.coefficients.toArray(), beta[:-1], rtol=1e-6, atol=1e-8)
    assert abs(m.intercept - beta[-1]) < 1e-6 * max(1, abs(beta[-1]))


def test_save_load_same_predictions(spark, silver_h, tmp_dir):
    tr, te = chronological_split(M.ml_frame(silver_h), 0.8)
    m = M.fit_linear(tr)
    path = os.path.join(tmp_dir, "model")
    M.save_model(m, path)
    back = M.load_model(path)
    a = [r.prediction for r in M.score(m, te).orderBy("open_time").collect()]
    b = [r.prediction for r in M.score(back, te).orderBy("open_time").collect()]
    assert a == b
    with pytest.raises(FileNotFoundError):
        M.load_model(os.path.join(tmp_dir, "missing"))


def test_metrics_match_evaluator(spark, silver_h):
    from pyspark.ml.evaluation import RegressionEvaluator
    tr, te = chronological_split(M.ml_frame(silver_h), 0.8)
    metrics, pred = M.evaluate(M.fit_linear(tr), te)
    r = metrics.first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName=name)
        assert abs(ev.evaluate(pred) - r[name]) < 1e-9


def test_assemble_skip_vs_error(spark):
    b = bars_df(spark, bar_rows([1.0, 2.0, 3.0]))
    from kandela.operators.features import add_features
    f = add_features(b)  # first row has NULL return
    assert M.assemble(f, handle_invalid="skip").count() == 2
    with pytest.raises(Exception):
        M.assemble(f).collect()


def test_train_job_refit(spark):
    s = silver(fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True), ["symbol"])
    res = run_training(s, ["symbol"], refit=True)
    r = res.metrics.first()
    assert 0 < r.n <= s.count() - int(0.8 * s.count()) + 2 and r.rmse >= 0 and res.feature_columns == FEATURE_COLUMNS


def _requests(spark, rows):
    return spark.createDataFrame(rows, "request_id long, symbol string, user_id long, "
                                 "requested_at timestamp_ntz, open_price double, high_price double, "
                                 "low_price double, close_price double, volume double, "
                                 "quote_asset_volume double, number_of_trades long, "
                                 "taker_buy_base_volume double, taker_buy_quote_volume double")


def test_set_scoring_equals_one_at_a_time(spark):
    hist = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A") +
                   bar_rows([float(50 + i) for i in range(1, 31)], symbol="B"), keyed=True)
    t = dt.datetime(2024, 1, 1, 0, 40)
    reqs = [(1, "A", 7, t, 1.0, 1.0, 1.0, 31.0, 2.0, 2.0, 3, 1.0, 0.5),
            (2, "B", 8, t, 1.0, 1.0, 1.0, 81.0, 0.0, 2.0, 3, 1.0, 0.5),
            (3, "A", 9, t + dt.timedelta(minutes=5), 1.0, 1.0, 1.0, 40.0, 2.0, 2.0, 3, 1.0, 0.5)]
    feats = {r.request_id: r for r in request_features(hist, _requests(spark, reqs)).collect()}
    for rid, sym, close in ((1, "A", 31.0), (3, "A", 40.0), (2, "B", 81.0)):
        prev = [float(i) for i in range(21, 31)] if sym == "A" else [float(50 + i) for i in range(21, 31)]
        closes = prev + [close]   # each request sees its own history only
        assert abs(feats[rid].MA_5 - np.mean(closes[-5:])) < 1e-12
        assert abs(feats[rid].MA_10 - np.mean(closes[-10:])) < 1e-12
        assert abs(feats[rid].return_1m - (closes[-1] - closes[-2]) / closes[-2]) < 1e-12
    assert feats[2].taker_ratio == 0.0  # zero volume, serving rule
    tr, _ = chronological_split(M.ml_frame(silver(hist, ["symbol"]), keep=["open_time"]), 0.8)
    m = M.fit_linear(tr)
    out = score_candidates(hist, _requests(spark, reqs), m).collect()
    assert {r.request_id for r in out} == {1, 2, 3}
    for r in out:  # the fitted model on each request's own features
        x = [float(feats[r.request_id][c]) for c in FEATURE_COLUMNS]
        assert r.status == "ok" and abs(r.predicted_price - (np.dot(m.coefficients.toArray(), x) + m.intercept)) < 1e-6
    assert all(r.prediction_for - r.timestamp == dt.timedelta(minutes=10) for r in out)


def test_e11_stale_request(spark):
    hist = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A"), keyed=True)
    old = dt.datetime(2024, 1, 1, 0, 10)  # older than newest history row
    reqs = [(1, "A", 7, old, 1.0, 1.0, 1.0, 31.0, 2.0, 2.0, 3, 1.0, 0.5)]
    req = _requests(spark, reqs)
    assert [r.status for r in request_features(hist, req).collect()] == ["stale"]  # rejected, and reported
    p = request_features(hist, req, parity=True).collect()
    assert len(p) == 1 and p[0].status == "stale"
    assert p[0].close == 30.0  # parity scores the newest history candle (G10)
    assert p[0].request_close == 31.0


def test_every_request_has_an_outcome(spark):
    hist = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A") + bar_rows([0.0], symbol="Z"), keyed=True)
    t = dt.datetime(2024, 1, 1, 0, 40)
    rest = (1.0, 1.0, 31.0, 2.0, 2.0, 3, 1.0, 0.5)
    reqs = [(1, "A", 7, t, 1.0, *rest), (2, "A", 7, dt.datetime(2024, 1, 1, 0, 29), 1.0, *rest), (3, "nope", 7, t, 1.0, *rest),
            (4, "A", 7, t, None, *rest), (5, None, 7, t, 1.0, *rest), (6, "Z", 7, t, 1.0, *rest), (7, "A", 7, None, 1.0, *rest)]
    m = M.fit_linear(M.ml_frame(silver(hist, ["symbol"])))
    out = {r.request_id: r for r in score_candidates(hist, _requests(spark, reqs), m).collect()}
    assert {i: out[i].status for i in range(1, 7)} == {1: "ok", 2: "stale", 3: "no_history", 4: "invalid", 5: "no_history", 6: "invalid"}
    assert len(out) == 7
    assert all((r.predicted_price is not None) == (r.status == "ok") for r in out.values())


def test_scoring_reads_only_the_days_it_needs(spark, tmp_dir):
    import os
    from kandela.plans.scoring import recent_history
    from kandela.sources.sinks import write_bronze
    from kandela.sources.tables import load_bars
    rows = bar_rows([1.0] * 4, "2024-01-01 00:00:00", symbol="A") + bar_rows([2.0] * 8, "2024-02-01 00:00:00", symbol="A") + \
        bar_rows([3.0] * 3, "2024-03-01 00:00:00", symbol="A") + bar_rows([9.0] * 2, "2023-01-01 00:00:00", symbol="B")
    path = os.path.join(tmp_dir, "bronze")
    write_bronze(bars_df(spark, rows, keyed=True), path)
    hist = load_bars(spark, path, keys=["symbol", "dt"])
    t = dt.datetime(2024, 3, 2)
    req = _requests(spark, [(1, "A", 7, t, *([1.0] * 6), 3, 1.0, 0.5)])
    got = recent_history(hist, req)
    assert sorted(r.close for r in got.collect()) == [2.0] * 8 + [3.0] * 3  # ten candles span two days
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "dt" in scan.split("]")[0] and "2024-01-01" not in scan.split("PushedFilters")[0]


def test_log_adds_nothing_twice(spark, tmp_dir):
    import os
    from kandela.plans.scoring import append_predictions, read_predictions
    hist = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A"), keyed=True)
    t = dt.datetime(2024, 1, 1, 0, 40)
    rest = (1.0, 1.0, 1.0, 31.0, 2.0, 2.0, 3, 1.0, 0.5)
    m = M.fit_linear(M.ml_frame(silver(hist, ["symbol"])))
    path = os.path.join(tmp_dir, "log")
    for reqs in ([(1, "A", 7, t, *rest), (2, "A", 8, t, *rest)], [(3, "A", 7, t, *rest), (4, "A", None, t, *rest)], [(4, "A", None, t, *rest)]):
        append_predictions(score_candidates(hist, _requests(spark, reqs), m), path)
    assert sorted(r.request_id for r in read_predictions(spark, path).collect()) == [1, 2, 4]
    settled = settle(read_predictions(spark, path), hist)
    assert {"actual_price", "error", "dt"} <= set(settled.columns) and settled.count() == 3


def test_settlement_adds_missing_columns_and_prunes_days(spark, tmp_dir):
    import os
    from kandela.plans.settlement import settle_log
    from kandela.sources.sinks import write_bronze
    from kandela.sources.tables import load_bars
    path, out = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "settled")
    write_bronze(bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A"), keyed=True), path)
    bars = load_bars(spark, path, keys=["symbol", "dt"])
    t = dt.datetime(2024, 1, 1, 0, 5)
    log = spark.createDataFrame([("A", t, t + dt.timedelta(minutes=10), 12.5, "v1", t.date())],
                                "symbol string, timestamp timestamp_ntz, prediction_for timestamp_ntz, predicted_price double, model_version string, dt date")
    r = settle(log, bars).first()
    assert (r.actual_price, r.error) == (16.0, -3.5)
    for _ in range(2):
        settle_log(log, bars, out)
        assert [x.actual_price for x in spark.read.parquet(out).collect()] == [16.0]


def test_one_cut_for_a_pooled_model(spark):
    from kandela.operators.split import pooled_split
    b = bars_df(spark, bar_rows([float(i) for i in range(200)], symbol="A") + bar_rows([float(i) for i in range(50)], symbol="B"), keyed=True)
    tr, te = pooled_split(b)
    assert (tr.count(), te.count()) == (200, 50)
    assert tr.agg(F.max("open_time")).first()[0] <= te.agg(F.min("open_time")).first()[0]


def test_unexpected_feature_columns_are_refused(spark):
    from kandela.plans.training import training_frame
    s = silver(bars_df(spark, bar_rows([float(i) for i in range(40)])))
    assert training_frame(s)[1] == FEATURE_COLUMNS
    with pytest.raises(ValueError, match="unexpected"):
        training_frame(s.withColumn("symbol", F.lit(7)))
    with pytest.raises(ValueError, match="missing"):
        training_frame(s.drop("MA_5"))


def test_settlement_and_monitor(spark):
    b = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A"), keyed=True)
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    preds = spark.createDataFrame(
        [(1, "A", t0, t0 + dt.timedelta(minutes=10), 1.0, 12.5, None, "v1.0.0", None),
         (1, "A", t0, t0 + dt.timedelta(days=3), 1.0, 12.5, None, "v1.0.0", None)],
        "user_id long, symbol string, timestamp timestamp_ntz, prediction_for timestamp_ntz, "
        "current_price double, predicted_price double, actual_price double, "
        "model_version string, error double")
    s = {r.prediction_for: r for r in settle(preds, b).collect()}
    hit = s[t0 + dt.timedelta(minutes=10)]
    assert hit.actual_price == 11.0 and hit.error == 1.5
    assert s[t0 + dt.timedelta(days=3)].actual_price is None
    m = monitor_daily(settle(preds, b)).first()
    assert (m.n_predictions, m.n_settled, m.rmse, m.mae) == (2, 1, 1.5, 1.5)


def test_flatten_keeps_order(spark, silver_h):
    f = M.flatten_features(M.ml_frame(silver_h)).first()
    s = silver_h.filter(F.col("open_time") == f.open_time).first()
    for c in FEATURE_COLUMNS:
        assert float(s[c]) == f[c]
