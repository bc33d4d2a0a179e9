"""Ranks by sampled ranges (W-5, W-6), mergeable fit (M-5), incremental silver (M-1, K-2), event-time features (R-3),
settlement and monitoring as streams (R-5, R-6)."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, bar_rows, bars_df
from kandela.operators import ordered
from kandela.operators.features import add_features, silver
from kandela.operators.ordered import range_index
from kandela.plans import fixtures as fx
from kandela.plans import model as M
from kandela.plans import moments
from kandela.plans.settlement import monitor_daily, settle
from kandela.plans.silver import SILVER, follow_landing, update_silver
from kandela.schema import FEATURE_COLUMNS, LABEL
from kandela.sources.sinks import land_candles, read_bronze, write_bronze
from kandela.sources.tables import load_bars
from kandela.streaming import event_time
from kandela.streaming.settlement import read_monitor, start_monitor, start_settling

FETCHED = dt.datetime(2030, 1, 1)


def fetched(df, at=FETCHED):
    return df.withColumn("fetched_at", F.lit(str(at)).cast("timestamp_ntz"))


# ---------------------------------------------------------------- ranks
def test_ranks_of_piled_up_rows_are_spread_and_exact(spark, tmp_dir, monkeypatch):
    n = 30_000
    t = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).cast("long")  # a third at 7, a third without a time
    df = spark.range(n).select(t.alias("t"), (F.col("id") % 4 == 0).alias("k"), F.lit("same").alias("v"))
    out = range_index(df, ["t"], ["k"], total_col="n").collect()
    for k in (True, False):
        own = sorted((r for r in out if r.k == k), key=lambda r: r.rn)
        assert [r.rn for r in own] == list(range(1, len(own) + 1)) and {r.n for r in own} == {len(own)}
        times = [(r.t is not None, r.t or 0) for r in own]
        assert times == sorted(times)
    # rows that are equal in everything lie in many ranges
    path = os.path.join(tmp_dir, "ranges")
    with monkeypatch.context() as m:
        m.setattr(ordered, "scratch_path", lambda *a: path)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
        range_index(df, ["t"])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < n / 4
    assert range_index(df.limit(0), ["t"], ["k"]).collect() == []


def test_ranks_equal_a_window(spark):
    b = fx.bronze(spark, SF_SMALL, fx.MINUTE, keyed=True).select("symbol", "open_time", "close")
    want = b.withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("open_time")))
    got = range_index(b, ["open_time"], ["symbol"])
    assert got.exceptAll(want.withColumn("rn", F.col("rn").cast("long"))).count() == 0 and got.count() == want.count()


# ---------------------------------------------------------------- mergeable fit
@pytest.fixture()
def table_of_days(spark):
    """Silver-like rows of eight days whose fit is well determined, some with missing values."""
    r = np.random.default_rng(4)
    rows = []
    for i in range(1600):
        x = (4.0 + r.normal(size=13)) * np.array([5, 5, 5, 5, 2, 40, 3, 2, 20, 0.5, 4, 4, 0.2])
        y = float(x @ np.linspace(0.1, 1.0, 13) + r.normal())
        x = [float(v) for v in x]
        if i % 97 == 0:
            x[i % 13] = None if i % 2 else float("nan")
        rows.append((*x, y, dt.date(2024, 1, 1 + i % 8)))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in moments.VARIABLES) + ", dt date")


def test_fit_from_day_sums_is_the_full_fit(spark, tmp_dir, table_of_days):
    df, path = table_of_days, os.path.join(tmp_dir, "sums")
    full = M.fit_linear(M.assemble(df.na.drop(), handle_invalid="error"), solver="normal")
    for days in ("dt < '2024-01-04'", "dt < '2024-01-05'", "true"):
        moments.update(df.filter(days), path)
    got = moments.refit(spark, path)
    assert np.allclose(got.coefficients.toArray(), full.coefficients.toArray(), rtol=1e-9, atol=0) and abs(got.intercept / full.intercept - 1) < 1e-9
    x = np.array([r[:-1] for r in df.na.drop().collect()], float)
    w = np.linalg.lstsq(np.column_stack([x[:, :-1], np.ones(len(x))]), x[:, -1], rcond=None)[0]
    assert np.allclose(got.coefficients.toArray(), w[:-1], rtol=1e-8)
    early = moments.refit(spark, path, until=dt.date(2024, 1, 4))
    want = M.fit_linear(M.assemble(df.filter("dt < '2024-01-04'").na.drop(), handle_invalid="error"), solver="normal")
    assert np.allclose(early.coefficients.toArray(), want.coefficients.toArray(), rtol=1e-9)
    # it scores, is saved and is loaded like any other
    M.save_model(got, os.path.join(tmp_dir, "model"))
    test = M.assemble(df.na.drop())
    a = M.score(M.load_model(os.path.join(tmp_dir, "model")), test).agg(F.sum("prediction")).first()[0]
    b = M.score(full, test).agg(F.sum("prediction")).first()[0]
    assert abs(a / b - 1) < 1e-9


def test_a_day_is_replaced_and_other_days_are_not_read(spark, tmp_dir, table_of_days):
    path, stored = os.path.join(tmp_dir, "sums"), os.path.join(tmp_dir, "silver")
    table_of_days.write.partitionBy("dt").parquet(stored)
    moments.update(spark.read.parquet(stored).filter("dt < '2024-01-08'"), path)
    seen = []
    plain = moments.usable

    def usable(df, *a):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *a)

    moments.usable, before = usable, moments.usable
    try:
        moments.update(spark.read.parquet(stored), path)  # the last day is new
    finally:
        moments.usable = before
    assert len(seen) == 1 and "dt" in seen[0][seen[0].index("PartitionFilters"):].split("]")[0]
    changed = table_of_days.withColumn(LABEL, F.col(LABEL) + 1)
    moments.update(changed, path, changed.select("dt").filter("dt = '2024-01-02'"))
    n, total = (moments.table(moments.read(spark, path)).filter(c).first()["value"] for c in ("a = 'one'", f"a = '{LABEL}' and b = 'one'"))
    scale = moments.read_scale(spark, path)
    rows = table_of_days.na.drop()
    want = rows.agg(F.sum(F.col(LABEL) + (F.col("dt") == "2024-01-02").cast("int"))).first()[0]
    assert n == rows.count() and abs((total * scale.by[-1] + n * scale.shift[-1]) / want - 1) < 1e-9


def test_dependent_variables_and_no_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0, 5.0 * i + 1) for i in range(20)], "a double, b double, c double, y double")
    scale = moments.Scale.of(df, ["a", "b", "c", "y"])
    w, b = moments.fit(moments.moments(df, scale, [], ["a", "b", "c", "y"]), scale, ["a", "b", "c", "y"])
    assert np.allclose([w @ [i, 2.0 * i, 3.0] + b for i in range(5)], [5.0 * i + 1 for i in range(5)])
    with pytest.raises(ValueError, match="no rows"):
        moments.fit(moments.moments(df.limit(0), scale, ["a"], ["a", "b", "c", "y"]).select("m"), scale, ["a", "b", "c", "y"])


# ---------------------------------------------------------------- incremental silver
def _series(seed):
    """Candles of three symbols on scattered days, some with few candles."""
    r = random.Random(seed)
    rows = []
    for s in ("A", "B", "007"):
        for d in sorted(r.sample(range(40), 12)):
            start = dt.datetime(2024, 3, 1) + dt.timedelta(days=d, minutes=r.randrange(60))
            rows.append((s, d, bar_rows([r.uniform(1, 9) for _ in range(r.choice([1, 2, 4, 12, 40]))], str(start), symbol=s)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_silver_that_follows_landings_is_the_full_build(spark, tmp_dir, seed):
    parts = _series(seed)
    random.Random(seed).shuffle(parts)
    bronze, out = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    cut = [parts[:20], parts[20:24], parts[24:25], parts[25:]]
    for batch in cut:
        land_candles(fetched(bars_df(spark, [r for _, _, rows in batch for r in rows], keyed=True)), bronze)
        follow_landing(spark, bronze, out)
        assert follow_landing(spark, bronze, out) is None  # nothing new
    # a fetch that changes candles of one day
    first = fetched(bars_df(spark, parts[0][2], keyed=True).withColumn("close", F.col("close") * 3), FETCHED + dt.timedelta(days=1))
    land_candles(first, bronze)
    rebuilt = follow_landing(spark, bronze, out)
    assert rebuilt.count() < 12
    got = load_bars(spark, out, SILVER, ["symbol"])
    want = silver(load_bars(spark, bronze, keys=["symbol"]), ["symbol"], method="global")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_an_update_reads_touched_days_and_their_neighbours_only(spark, tmp_dir, monkeypatch):
    from kandela.plans import silver as S
    rows = bar_rows([float(i % 11 + 1) for i in range(30 * 48)], "2024-01-01 00:00:00", step_minutes=30, symbol="A")
    bronze, out = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    write_bronze(fetched(bars_df(spark, rows, keyed=True)), bronze)
    update_silver(read_bronze(spark, bronze), out)
    read, plain = [], S._partitions

    def partitions(table, wanted):
        read.append({r.dt.day for r in wanted.select("dt").distinct().collect()})
        part = plain(table, wanted)
        assert "dt" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
        return part

    monkeypatch.setattr(S, "_partitions", partitions)
    rebuilt = update_silver(read_bronze(spark, bronze), out, spark.createDataFrame([("A", dt.date(2024, 1, 15))], "symbol string, dt date"))
    assert {r.dt.day for r in rebuilt.collect()} == {14, 15, 16}
    assert read == [{15}, {13, 14, 15, 16, 17}]


# ---------------------------------------------------------------- streams
def _online(spark, src, schema, tmp_dir, delay, cap):
    out = os.path.join(tmp_dir, f"out{cap}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", cap).parquet(src)
    writer = event_time.ordered_features(stream, delay).writeStream.format("parquet").option("checkpointLocation", os.path.join(tmp_dir, f"ck{cap}")).trigger(availableNow=True)
    event_time.start(writer, spark, out).awaitTermination(300)
    return spark.read.schema(event_time.OUTPUT).parquet(out).filter("symbol <> '~'")


def _end(spark, b, src):
    last = b.orderBy(F.desc("open_time")).limit(1).withColumn("symbol", F.lit("~")).withColumn("open_time", F.col("open_time") + F.expr("INTERVAL 3000 DAYS"))
    last.coalesce(1).write.mode("append").parquet(src)


@pytest.mark.parametrize("cap", [1, 4])
def test_shuffled_candles_come_out_in_order(spark, tmp_dir, cap):
    r = random.Random(3)
    rows = [x for s in "AB" for x in bar_rows([r.choice([None, r.uniform(1, 9)]) if i == 5 else r.uniform(1, 9) for i in range(60)], symbol=s)]
    b, src = bars_df(spark, rows, keyed=True), os.path.join(tmp_dir, "bars")
    r.shuffle(rows)
    for i in range(0, len(rows), 20):
        bars_df(spark, rows[i:i + 20], keyed=True).coalesce(1).write.mode("append").parquet(src)
    _end(spark, b, src)
    got = _online(spark, src, b.schema, tmp_dir, "2 hours", cap)
    want = add_features(b, ["symbol"], with_target=False, ratio_on_zero="zero", method="global")
    cols = ["symbol", "open_time", "close", "return_1m", "MA_5", "MA_10", "taker_ratio"]
    near = lambda df: df.select(*[F.round(c, 9).alias(c) if c in cols[3:] else c for c in cols])
    assert got.count() == b.count() and {x.status for x in got.select("status").distinct().collect()} == {"ok"}
    assert near(got).exceptAll(near(want)).count() == 0


def test_late_and_repeated_candles_come_out_marked(spark, tmp_dir):
    rows, src = bar_rows([float(i) for i in range(1, 9)], symbol="A"), os.path.join(tmp_dir, "bars")
    b = bars_df(spark, rows, keyed=True)
    for batch in ([rows[1], rows[3]], [rows[7], rows[2], rows[2]], [rows[0], rows[6]], [rows[4], rows[5]]):
        bars_df(spark, batch, keyed=True).coalesce(1).write.mode("append").parquet(src)
    _end(spark, b, src)
    got = _online(spark, src, b.schema, tmp_dir, "2 minutes", 1).collect()
    assert len(got) == 9  # one for each row that came in
    ok = sorted((x for x in got if x.status == "ok"), key=lambda x: x.open_time)
    assert len({x.open_time for x in ok}) == len(ok) and {x.close for x in got} == {float(i) for i in range(1, 9)}
    assert all(x.MA_5 is None and x.return_1m is None for x in got if x.status != "ok")
    assert {x.status for x in got} == {"ok", "late", "repeat"}
    closes = [x.close for x in ok]
    assert [x.return_1m for x in ok][1:] == [(q - p) / p for p, q in zip(closes, closes[1:])]


def test_settling_as_a_stream_equals_the_batch(spark, tmp_dir):
    bars = bars_df(spark, bar_rows([float(i) for i in range(1, 41)], symbol="A", gaps=(20,)), keyed=True)
    t0 = dt.datetime(2024, 1, 1)
    preds = [("A", t0 + dt.timedelta(minutes=i), t0 + dt.timedelta(minutes=i + 10), float(i), "v1" if i % 3 else "v2") for i in range(40)]
    schema = "symbol string, timestamp timestamp_ntz, prediction_for timestamp_ntz, predicted_price double, model_version string"
    p = spark.createDataFrame(preds, schema)
    far = spark.createDataFrame([("~", t0, t0 + dt.timedelta(days=3000), 0.0, "v1")], schema)
    a, b, out, ck = (os.path.join(tmp_dir, n) for n in ("p", "b", "out", "ck"))
    for i in range(0, 40, 8):
        p.filter(F.minute("timestamp").between(i, i + 7)).coalesce(1).write.mode("append").parquet(a)
    far.coalesce(1).write.mode("append").parquet(a)
    bars.orderBy("open_time").coalesce(1).write.parquet(b)
    _end(spark, bars, b)
    read = lambda path, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)
    start_settling(read(a, p), read(b, bars), out, ck, delay="2 hours").awaitTermination(300)
    got = spark.read.parquet(out).filter("symbol <> '~'")
    want = settle(p, bars)
    assert got.count() == 40 and got.select(*want.columns).exceptAll(want).count() == 0
    assert 0 < got.filter("actual_price is null").count() < 15
    # the monitor, after any split into batches
    for cap in (1, 3):
        src, table, ck = (os.path.join(tmp_dir, f"{n}{cap}") for n in ("settled", "monitor", "monitor-ck"))
        want.repartition(5, "timestamp").write.parquet(src)
        start_monitor(spark.readStream.schema(want.schema).option("maxFilesPerTrigger", cap).parquet(src), table, ck).awaitTermination(300)
        rounded = lambda df: sorted((x.day, x.model_version, x.n_predictions, x.n_settled, round(x.rmse, 9), round(x.mae, 9)) for x in df.collect())
        assert rounded(read_monitor(spark, table)) == rounded(monitor_daily(want))
