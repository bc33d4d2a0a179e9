"""Profiles merged from day states (A-2, A-4 ... A-6, M-10, M-11)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import bar_rows, bars_df
from kandela.operators import quality as Q
from kandela.plans import profile as P
from kandela.sources.sinks import land_candles, read_bronze


def near(a, b, rel=1e-12):
    assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=rel, abs=1e-12))


def test_merged_states_equal_a_profile_of_all_rows(spark):
    r = random.Random(1)
    rows = [(r.choice(["A", "B", None]), r.randint(1, 6), r.choice([None, float("nan"), 1e9 + r.random(), 1e9 + r.random()]), None, r.randint(-5, 5)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "symbol string, dt int, x double, none double, i int")
    cols = ["x", "none", "i"]
    got = {p.column_name: p for p in P.profile(P.states(df, cols)).collect()}
    valid = df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for want in Q.describe_long(valid, cols).collect():
        p = got[want.column_name]
        assert (p.row_count, p["count"]) == (4000, want["count"])
        assert p.row_count == p["count"] + p.null_count + p.nan_count
        for c in ("mean", "min", "max"):
            near(p[c], want[c])
        near(p.stddev, want.stddev, 1e-7)  # a double near 10^9, such as a day's mean of x, has no finer steps
    assert got["none"].Q1 is None and got["none"].lower_bound is None and got["x"].nan_count > 0
    each = P.profile(P.states(df, cols), ["symbol"])
    assert each.count() == 9 and each.agg(F.sum("row_count")).first()[0] == 12000
    assert P.profile(P.states(df.limit(0), cols)).collect() == []


def test_merged_quantiles_are_within_the_rank_bound(spark):
    r = random.Random(2)
    values = [r.lognormvariate(0, 2) for _ in range(60_000)]
    df = spark.createDataFrame([("A", i * 30 // len(values), v) for i, v in enumerate(sorted(values))], "symbol string, dt int, x double")  # days have different ranges
    p = P.profile(P.states(df, ["x"])).first()
    for q, v in ((0.25, p.Q1), (0.5, p.median), (0.75, p.Q3)):
        assert abs(sum(x <= v for x in values) / len(values) - q) <= 3.5 / P.SKETCH
    near(p.lower_bound, p.Q1 - 1.5 * (p.Q3 - p.Q1))
    near(p.upper_bound, p.Q3 + 1.5 * (p.Q3 - p.Q1))


def test_states_follow_landing_and_read_new_days_only(spark, tmp_dir, monkeypatch):
    r = random.Random(3)
    bronze, kept = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "states")
    days = [bar_rows([r.random() for _ in range(20)], f"2024-01-{d:02d} 00:00:00", symbol=s) for d in range(1, 7) for s in "AB"]
    read, plain = [], P._partitions

    def partitions(table, wanted):
        read.append(sorted({x.dt.day for x in wanted.collect()}))
        return plain(table, wanted)

    monkeypatch.setattr(P, "_partitions", partitions)
    for part in (days[4:8], days[8:], days[:4], [bar_rows([7.0], "2024-01-02 00:00:00", symbol="A")]):
        land_candles(bars_df(spark, [x for d in part for x in d], keyed=True).withColumn("fetched_at", F.lit(f"2030-01-0{len(read) + 1} 00:00:00").cast("timestamp_ntz")), bronze)
        P.follow_landing(spark, bronze, kept)
    assert read == [[5, 6], [1, 2], [2]]
    whole = P.profile(P.states(read_bronze(spark, bronze))).orderBy("column_name").collect()
    merged = P.profile(P.read_states(spark, kept)).orderBy("column_name").collect()
    assert len(whole) == len(merged) == len(P.COLUMNS)
    for a, b in zip(merged, whole, strict=True):
        assert (a.column_name, a.row_count, a["count"], a.min, a.max) == (b.column_name, b.row_count, b["count"], b.min, b.max)
        near(a.mean, b.mean)
        near(a.stddev, b.stddev)
