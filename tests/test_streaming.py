"""Structured Streaming jobs equal their batch counterparts (R-1 ... R-4)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from kandela.operators.features import add_features, silver
from kandela.plans import fixtures as fx
from kandela.plans import model as M
from kandela.plans.scoring import read_predictions
from kandela.sources.payload import to_payloads
from kandela.sources.sinks import land_candles, read_bronze, touched
from kandela.sources.tables import load_bars
from kandela.streaming.ingest import ingest_bronze, land_bronze, write_payload_files
from kandela.streaming.online import VALUE_COLS, online_features
from kandela.streaming.scoring import start_scoring

FEATS = ["return_1m", "MA_5", "MA_10", "taker_ratio"]


def test_landing_dedups_overlapping_fetches(spark, tmp_dir):
    b = fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True)
    docs = to_payloads(b, ["symbol"], per="day")
    src = os.path.join(tmp_dir, "payloads")
    write_payload_files(docs, src)
    write_payload_files(docs, src)   # a second, fully overlapping fetch
    out = os.path.join(tmp_dir, "bronze")
    ck = os.path.join(tmp_dir, "ck")
    q = land_bronze(spark, src, out, ck)
    q.awaitTermination(300)
    landed = load_bars(spark, out, keys=["symbol"])
    assert landed.count() == b.count()
    assert landed.exceptAll(b).count() == 0
    # restart: nothing new, nothing duplicated
    land_bronze(spark, src, out, ck).awaitTermination(300)
    assert spark.read.parquet(out).count() == b.count()
    # a batch, and any file cap, give the same table
    ingest_bronze(spark, src, os.path.join(tmp_dir, "batch"))
    capped = os.path.join(tmp_dir, "capped")
    land_bronze(spark, src, capped, os.path.join(tmp_dir, "ck2"), max_files_per_trigger=15).awaitTermination(600)
    for other in (os.path.join(tmp_dir, "batch"), capped):
        rows = load_bars(spark, other, keys=["symbol"])
        assert rows.count() == b.count() and rows.exceptAll(b).count() == 0


def test_latest_fetch_wins_in_any_order_and_old_candles_land(spark, tmp_dir):
    from conftest import bar_rows, bars_df
    new = bars_df(spark, bar_rows([1.0, 2.0], "2024-05-01 00:00:00", symbol="007"), keyed=True)
    fetched = lambda df, day: df.withColumn("fetched_at", F.lit(f"2024-06-{day} 00:00:00").cast("timestamp_ntz"))
    old = bars_df(spark, bar_rows([7.0], "2023-01-01 00:00:00", symbol="007"), keyed=True)
    stale = new.withColumn("close", F.col("close") + 5)
    batches = [fetched(new, "09"), fetched(stale, "01"), fetched(old, "02"), fetched(new, "09")]
    for order in ([0, 1, 2, 3], [2, 1, 0, 1]):
        out = os.path.join(tmp_dir, f"bronze{order[0]}")
        for i in order:
            land_candles(batches[i], out)
        rows = load_bars(spark, out, keys=["symbol", "dt"]).orderBy("open_time").collect()
        assert [(r.symbol, r.close) for r in rows] == [("007", 7.0), ("007", 1.0), ("007", 2.0)]
    plan = touched(read_bronze(spark, out), batches[2].withColumn("dt", F.to_date("open_time")))._jdf.queryExecution().executedPlan().toString()
    assert "dt" in plan[plan.index("PartitionFilters"):].split("]")[0] and "2023-01-01" in plan.replace("19358", "2023-01-01")


def test_numeric_tickers_keep_their_names(spark, tmp_dir):
    from conftest import bar_rows, bars_df
    from kandela.plans.silver import SILVER, build_silver, write_silver
    from kandela.plans.training import run_training
    from kandela.schema import FEATURE_COLUMNS
    rows = bar_rows([float(i % 9 + 1) for i in range(60)], symbol="007") + bar_rows([float(i % 7 + 2) for i in range(60)], symbol="600519")
    b = bars_df(spark, rows, keyed=True).withColumn("fetched_at", F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"))
    bronze, out = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    land_candles(b, bronze)
    write_silver(build_silver(load_bars(spark, bronze, keys=["symbol"]), ["symbol"]), out, ["symbol"])
    s = load_bars(spark, out, SILVER, ["symbol"])
    assert {r.symbol for r in s.select("symbol").distinct().collect()} == {"007", "600519"}
    assert run_training(s, ["symbol"]).feature_columns == FEATURE_COLUMNS


def _day_files(spark, b, path):
    days = [r[0] for r in b.select(F.to_date("open_time")).distinct().orderBy(1).collect()]
    for d in days:
        b.filter(F.to_date("open_time") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
    return len(days)


def test_online_features_equal_batch(spark, tmp_dir):
    b = fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True)
    src = os.path.join(tmp_dir, "bars")
    _day_files(spark, b, src)
    stream = spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 3).parquet(src)
    q = (online_features(stream).writeStream.format("memory").queryName("online_test")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("online_test")
    want = add_features(b, keys=["symbol"], with_target=False, ratio_on_zero="zero")
    cols = ["symbol", "open_time", *VALUE_COLS, *FEATS]
    r = lambda df: df.select(*[F.round(c, 9).alias(c) if c in FEATS else F.col(c) for c in cols])
    assert got.count() == want.count()
    assert r(got).exceptAll(r(want)).count() == 0
    assert got.agg(F.max("late_rows")).first()[0] == 0


def test_online_means_skip_missing_closes(spark, tmp_dir):
    from conftest import bar_rows, bars_df
    rows = bar_rows([1.0, None, 3.0, 4.0], symbol="A")
    src = os.path.join(tmp_dir, "bars")
    b = bars_df(spark, rows, keyed=True)
    b.coalesce(1).write.parquet(src)
    q = (online_features(spark.readStream.schema(b.schema).parquet(src)).writeStream.format("memory").queryName("null_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = [(r.MA_5, r.MA_10, r.return_1m) for r in spark.table("null_test").orderBy("open_time").collect()]
    want = [(r.MA_5, r.MA_10, r.return_1m) for r in add_features(b, keys=["symbol"], with_target=False).orderBy("open_time").collect()]
    assert got == want


def test_online_rejects_late_rows(spark, tmp_dir):
    from conftest import bar_rows, bars_df
    rows = bar_rows([1.0, 2.0, 3.0, 4.0], symbol="A")
    src = os.path.join(tmp_dir, "bars")
    bars_df(spark, rows[:3], keyed=True).coalesce(1).write.parquet(src)
    # second fetch: candle 1 again (late) and candle 4 (new)
    bars_df(spark, [rows[0], rows[3]], keyed=True).coalesce(1).write.mode("append").parquet(src)
    schema = bars_df(spark, rows, keyed=True).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (online_features(stream).writeStream.format("memory").queryName("late_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    out = spark.table("late_test").orderBy("open_time").collect()
    assert [r.close for r in out] == [1.0, 2.0, 3.0, 4.0]
    assert out[-1].late_rows == 1
    assert out[-1].MA_5 == 2.5 and out[-1].return_1m == (4.0 - 3.0) / 3.0


def test_stream_scoring_idempotent(spark, tmp_dir):
    b = fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True)
    from kandela.operators.split import chronological_split
    tr, _ = chronological_split(M.ml_frame(silver(b, ["symbol"])), 0.8)
    model = M.fit_linear(tr)
    src = os.path.join(tmp_dir, "bars")
    _day_files(spark, b, src)
    feats = online_features(spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 5)
                            .parquet(src))
    log, ck = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ck")
    start_scoring(feats, model, log, ck).awaitTermination(300)
    n1 = read_predictions(spark, log).count()
    start_scoring(feats, model, log, ck).awaitTermination(300)  # restart from checkpoint
    logged = read_predictions(spark, log)
    assert logged.count() == n1
    assert logged.select("symbol", "timestamp").distinct().count() == n1
    assert n1 == b.count() - b.select("symbol").distinct().count()  # first row per symbol lacks a return


def test_landing_skips_candles_still_open_at_fetch(spark, tmp_dir):
    """A fetch's newest candle may still be open (close time after the file
    was written): it is not landed, so a first-wins de-duplication never keeps
    its partial values."""
    closed = ('[[1704067200000,"1.0","1.0","1.0","1.0","2.0",1704067259999,"2.0",1,"1.0","1.0","0"],'
              '[4102444800000,"9.0","9.0","9.0","9.0","2.0",4102444859999,"2.0",1,"1.0","1.0","0"]]')
    src = os.path.join(tmp_dir, "payloads", "symbol=XYZUSD")
    os.makedirs(src)
    with open(os.path.join(src, "fetch-1.json"), "w") as fh:
        fh.write(closed)
    out = os.path.join(tmp_dir, "bronze")
    land_bronze(spark, os.path.dirname(src), out, os.path.join(tmp_dir, "ck")).awaitTermination(300)
    rows = spark.read.parquet(out).collect()
    assert [(r.symbol, r.close) for r in rows] == [("XYZUSD", 1.0)]
