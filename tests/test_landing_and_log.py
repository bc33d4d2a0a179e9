"""Landing without loss (K-1, R-1), ties (T-1, T-2), requests without a time (M-9, K-7), inline requests (S-4),
model availability (S-6), settlement of far and missing horizons (R-5)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import bar_rows, bars_df
from kandela import cli
from kandela.operators import topk as T
from kandela.operators.features import silver
from kandela.plans import model as M
from kandela.plans.scoring import append_predictions, read_predictions, requests_frame, score_candidates
from kandela.plans.settlement import settle_log
from kandela.sources.sinks import changes_path, land_candles, rejects_path, write_bronze
from kandela.sources.tables import load_bars
from kandela.streaming.ingest import ingest_bronze, land_bronze

FETCHED = "2024-06-09 00:00:00"


def _kline(minute, close, open_time=True):
    t = 1704067200000 + 60_000 * minute
    return [t if open_time else None, "1.0", "1.0", "1.0", str(close), "2.0", t + 59_999, "2.0", 1, "1.0", "1.0", "0"]


def _write(folder, name, klines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        json.dump(klines, fh)


def test_payloads_without_a_symbol_folder_lose_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "bronze")
    for i in range(2):  # two fetches of one day
        src = os.path.join(tmp_dir, f"fetch{i}")
        _write(src, "klines.json", [_kline(i, 1.0 + i), _kline(9, 9.0, open_time=False)])
        ingest_bronze(spark, src, out, symbol="BTCUSDT")
        ingest_bronze(spark, src, out, symbol="BTCUSDT")
    rows = load_bars(spark, out, keys=["symbol", "dt"]).orderBy("open_time").collect()
    assert [(r.symbol, r.close) for r in rows] == [("BTCUSDT", 1.0), ("BTCUSDT", 2.0)]
    rejects = spark.read.parquet(rejects_path(out)).collect()
    assert {(r.symbol, r.close, r.open_time) for r in rejects} == {("BTCUSDT", 9.0, None)} and len(rejects) == 2  # one of each file
    assert spark.read.parquet(changes_path(out)).select("symbol", "dt").distinct().count() == 1
    streamed = os.path.join(tmp_dir, "streamed")
    cli.main(["land", "--payloads", os.path.join(tmp_dir, "fetch*"), "--bronze", streamed, "--checkpoint", os.path.join(tmp_dir, "ck"),
              "--max-files", "1", "--symbol", "BTCUSDT"], spark)
    again = load_bars(spark, streamed, keys=["symbol", "dt"]).orderBy("open_time").collect()
    assert [r.close for r in again] == [1.0, 2.0]
    with pytest.raises(Exception, match="no symbol is known for the payload file .*klines.json"):
        ingest_bronze(spark, os.path.join(tmp_dir, "fetch0"), out)
    with pytest.raises(Exception, match="no symbol is known"):
        land_bronze(spark, os.path.join(tmp_dir, "fetch0"), out, os.path.join(tmp_dir, "ck2")).awaitTermination(120)


def test_candles_without_symbol_or_time_are_put_aside_once(spark, tmp_dir):
    rows = bar_rows([1.0, 2.0, 3.0], symbol="A")
    rows[0]["open_time"] = None
    rows[1]["symbol"] = None
    good = bars_df(spark, rows, keyed=True).withColumn("fetched_at", F.lit(FETCHED).cast("timestamp_ntz"))
    empty = good.filter("close = 3").withColumn("symbol", F.lit("")).withColumn("close", F.lit(4.0))
    out = os.path.join(tmp_dir, "bronze")
    for batch in (good, empty, good, empty):
        land_candles(batch, out)
    assert [r.close for r in load_bars(spark, out, keys=["symbol", "dt"]).collect()] == [3.0]
    assert sorted(r.close for r in spark.read.parquet(rejects_path(out)).collect()) == [1.0, 2.0, 4.0]


def test_equal_times_count_once_and_the_greatest_row_is_taken(spark):
    rows = bar_rows([float(i) for i in range(1, 16)], symbol="A")
    twice = [{**r, "close": r["close"] + k} for r in rows for k in (0.25, 0.0, 0.5)]
    b = bars_df(spark, twice + bar_rows([7.0], symbol="B"), keyed=True)
    for parts in (1, 7):
        d = b.repartition(parts, "close")
        got = T.latest_k_per_key(d, ["symbol"], 10, rank_col="rank").filter("symbol = 'A'").orderBy("rank").collect()
        assert [(r["rank"], r.close) for r in got] == [(i + 1, 15.5 - i) for i in range(10)]
        assert [r.close for r in T.latest_k(d.filter("symbol = 'A'"), 3).collect()] == [13.5, 14.5, 15.5]
        assert {(r.symbol, r.close) for r in T.latest_row(d, ["symbol"]).collect()} == {("A", 15.5), ("B", 7.0)}
    assert T.latest_k(b.limit(0), 3).collect() == []
    assert T.latest_k(b, 2).columns == b.columns == T.latest_row(b, ["symbol"]).columns


@pytest.fixture()
def scored(spark):
    hist = bars_df(spark, bar_rows([float(i) for i in range(1, 31)], symbol="A"), keyed=True)
    return hist, M.fit_linear(M.ml_frame(silver(hist, ["symbol"])))


def test_a_request_without_a_time_is_invalid_and_never_logged(spark, tmp_dir, scored):
    hist, model = scored
    rest = dict(symbol="A", user_id=7, open_price=1, high_price=1.0, low_price=1.0, close_price=31.0, volume=2.0, quote_asset_volume=2.0,
                number_of_trades=3, taker_buy_base_volume=1.0, taker_buy_quote_volume=0.5)
    req = requests_frame(spark, [{"request_id": 1, **rest}, {"request_id": 2, "requested_at": "2024-01-01T00:40:00", **rest}])
    out = score_candidates(hist, req, model)
    assert {r.request_id: r.status for r in out.collect()} == {1: "invalid", 2: "ok"}
    log = os.path.join(tmp_dir, "log")
    for _ in range(2):
        append_predictions(out, log)
        append_predictions(out.withColumn("status", F.lit("ok")), log)  # a caller's own row without a time
    assert sorted(r.request_id for r in read_predictions(spark, log).collect()) == [1, 2]
    with pytest.raises(ValueError, match="no fields"):
        requests_frame(spark, [{"request_id": 1, "prize": 3}])


def test_inline_requests_through_the_job(spark, tmp_dir, scored):
    hist, model = scored
    p = lambda n: os.path.join(tmp_dir, n)
    write_bronze(hist, p("bronze"))
    M.save_model(model, p("model"))
    row = dict(request_id=5, symbol="A", user_id=1, requested_at="2024-01-01T00:40:00", open_price=30.0, high_price=31.0, low_price=30.0, close_price=31.0,
               volume=2.0, quote_asset_volume=2.0, number_of_trades=3, taker_buy_base_volume=1.0, taker_buy_quote_volume=0.5)
    cli.main(["score", "--bronze", p("bronze"), "--inline", json.dumps([row]), "--model", p("model"), "--log", p("log")], spark)
    assert [r.request_id for r in read_predictions(spark, p("log")).collect()] == [5]


def test_models_are_looked_for_where_spark_looks(spark, tmp_dir, scored):
    path = os.path.join(tmp_dir, "model")
    M.save_model(scored[1], path)
    assert M.available(spark, path) and M.available(spark, f"file://{path}") and not M.available(spark, f"file://{path}-none")
    with pytest.raises(FileNotFoundError):
        M.load_model(f"file://{path}-none")
    assert M.load_model(f"file://{path}").coefficients == scored[1].coefficients


def test_settlement_of_far_missing_and_timeless_rows(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 0, 5)
    path, out = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "settled")
    schema = "symbol string, timestamp timestamp_ntz, prediction_for timestamp_ntz, predicted_price double, model_version string, dt date"
    day = dt.timedelta(days=1)
    log = spark.createDataFrame([("A", t, t + 3 * day, 12.5, "far", t.date()), ("A", t + day, t + day + dt.timedelta(minutes=10), 1.0, "missing", (t + day).date()),
                                 ("A", None, None, 1.0, "timeless", None), ("A", t + 4 * day, t + 9 * day, 1.0, "pending", (t + 4 * day).date())], schema)
    write_bronze(bars_df(spark, bar_rows([float(i) for i in range(1, 9)], symbol="A"), keyed=True), path)
    bars = lambda: load_bars(spark, path, keys=["symbol", "dt"])
    settle_log(log, bars(), out)
    state = lambda: {r.model_version: (r.actual_price, r.final) for r in spark.read.parquet(out).collect()}
    assert state() == {"far": (None, False), "missing": (None, False), "timeless": (None, True), "pending": (None, False)}
    write_bronze(bars_df(spark, bar_rows([float(i) for i in range(1, 9)], "2024-01-04 00:00:00", symbol="A"), keyed=True), path)
    settle_log(log, bars(), out)
    assert state() == {"far": (6.0, True), "missing": (None, True), "timeless": (None, True), "pending": (None, False)}
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")}
    settle_log(log, bars(), out)  # only the pending day is written again
    after = {f for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")}
    assert len(set(before) - after) == 1 and state()["far"] == (6.0, True)
