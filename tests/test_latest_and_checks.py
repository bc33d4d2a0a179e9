"""Newest candles as a maintained table (M-9, T-1); write check by digests of partitions (K-5)."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from conftest import bar_rows, bars_df
from kandela.operators.topk import latest_k_per_key
from kandela.plans import latest as L
from kandela.schema import BRONZE, with_keys
from kandela.sources import sinks
from kandela.sources.sinks import check_partitions, digests, land_candles, read_bronze, write_bronze, write_check

COLUMNS = with_keys(BRONZE).names
FETCHED = dt.datetime(2030, 1, 1)


def fetched(df, at=FETCHED):
    return df.withColumn("fetched_at", F.lit(str(at)).cast("timestamp_ntz"))


def same(a, b):
    a, b = a.select(*COLUMNS), b.select(*COLUMNS)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_newest_candles_follow_landing_in_any_order(spark, tmp_dir):
    r = random.Random(4)
    bronze, table = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "latest")
    parts = []
    for symbol in "ABCDE":
        for day in range(1, 9):  # few candles a day, so that the newest ten lie in several days
            parts.append(bar_rows([r.random() for _ in range(r.randint(1, 5))], f"2024-01-{day:02d} 09:00:00", symbol=symbol))
    parts.append(bar_rows([1.0, 2.0], "2024-01-03 00:00:00", symbol="few"))
    r.shuffle(parts)
    assert L.follow_landing(spark, bronze, table) is None
    for cut in (parts[:15], parts[15:30], parts[30:]):
        land_candles(fetched(bars_df(spark, [x for p in cut for x in p], keyed=True)), bronze)
        L.follow_landing(spark, bronze, table)
        assert L.follow_landing(spark, bronze, table) is None  # nothing new
        same(L.read_latest(spark, table), latest_k_per_key(read_bronze(spark, bronze).select(*COLUMNS), ["symbol"], 10))
    # a later fetch corrects a candle that the table holds
    row = L.read_latest(spark, table).filter("symbol = 'A'").withColumn("close", F.col("close") + 5)
    land_candles(fetched(row, FETCHED + dt.timedelta(days=1)), bronze)
    L.follow_landing(spark, bronze, table)
    same(L.read_latest(spark, table), latest_k_per_key(read_bronze(spark, bronze).select(*COLUMNS), ["symbol"], 10))


def test_days_that_are_too_old_are_not_read(spark, tmp_dir):
    bronze, table = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "latest")
    land_candles(fetched(bars_df(spark, bar_rows([1.0] * 30, "2024-03-01 00:00:00", symbol="A") + bar_rows([1.0] * 4, "2024-03-01 00:00:00", symbol="B"), keyed=True)), bronze)
    L.follow_landing(spark, bronze, table)
    old = bar_rows([2.0] * 20, "2024-02-01 00:00:00", symbol="A") + bar_rows([2.0] * 3, "2024-02-01 00:00:00", symbol="B")
    land_candles(fetched(bars_df(spark, old, keyed=True)), bronze)
    needed = L.follow_landing(spark, bronze, table).collect()
    assert [(x.symbol, str(x.dt)) for x in needed] == [("B", "2024-02-01")]  # A has its ten in March
    assert L.read_latest(spark, table).groupBy("symbol").count().orderBy("symbol").collect() == [("A", 10), ("B", 7)]


def test_an_empty_history_has_no_newest_candles(spark, tmp_dir):
    empty = fetched(bars_df(spark, [], keyed=True)).withColumn("dt", F.to_date("open_time"))
    L.update_latest(empty, os.path.join(tmp_dir, "latest"))
    land_candles(fetched(bars_df(spark, bar_rows([1.0], symbol="A"), keyed=True)), os.path.join(tmp_dir, "bronze"))
    L.follow_landing(spark, os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "latest"))
    assert L.read_latest(spark, os.path.join(tmp_dir, "latest")).count() == 1


KIND = "g string, a long, b long, x double, t string"
ROWS = [("p", 1, None, 0.0, "u"), ("p", 2, 3, 1.5, None), ("q", 1, 1, None, ""), ("q", 1, 1, None, ""), (None, 5, 6, float("nan"), "v")]


def test_digests_tell_multisets_apart(spark):
    of = lambda rows: {r.g: (r.n, r.h1, r.h2) for r in digests(spark.createDataFrame(rows, KIND), ["g"]).collect()}
    base = of(ROWS)
    assert of(ROWS[::-1]) == base and set(base) == {"p", "q", None}
    assert of([("p", 1, None, -0.0, "u"), *ROWS[1:]]) == base
    for i, other in enumerate([("p", None, 1, 0.0, "u"), ("p", 2, 3, 1.5, ""), ("q", 1, 1, 0.0, ""), ("q", 1, 1, None, None)]):
        changed = [*ROWS[:i], other, *ROWS[i + 1:]]
        assert [g for g in base if of(changed)[g] != base[g]] == [other[0]]
    assert of(ROWS[:3] + ROWS[4:])["q"] != base["q"]  # a row less of two equal ones


def test_check_equals_the_whole_comparison(spark):
    r = random.Random(6)
    rows = [(r.choice(["p", "q", "s", None]), r.randint(0, 3), r.choice([None, 1]), r.choice([0.0, 1.5, None]), r.choice("uv")) for _ in range(300)]
    a = spark.createDataFrame(rows, KIND)
    for other in (rows, rows[5:], rows + rows[:9], [("new", 1, 1, 1.0, "u"), *rows[1:]], []):
        b = spark.createDataFrame(other, KIND)
        for by in (["g"], ["g", "a"], []):
            assert check_partitions(a, b, by).collect() == write_check(a, b).collect()


def test_rows_are_shuffled_only_where_partitions_differ(spark, tmp_dir, monkeypatch):
    rows = [x for s in "AB" for x in bar_rows([float(i) for i in range(60 * 24 * 3)], "2024-01-01 00:00:00", symbol=s)]
    good, bad = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    df = bars_df(spark, rows, keyed=True)
    write_bronze(df, good)
    write_bronze(df.withColumn("close", F.when((F.col("symbol") == "B") & (F.col("open_time") == F.lit("2024-01-02 05:00:00").cast("timestamp_ntz")), 0.5).otherwise(F.col("close"))), bad)
    compared, plain = [], write_check

    def spy(s, t):
        compared.append((s.count(), t.count()))
        return plain(s, t)

    monkeypatch.setattr(sinks, "write_check", spy)
    a, b = spark.read.parquet(good), spark.read.parquet(bad)
    assert check_partitions(a, a).collect() == [(8640, 8640, 0, 0)] and compared == []
    assert check_partitions(a, b).collect() == [(8640, 8640, 1, 1)] and compared == [(1440, 1440)]
    plan = digests(a, ["symbol", "dt"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange"):].splitlines()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" in exchange[1] and "partial_count" in exchange[1]
