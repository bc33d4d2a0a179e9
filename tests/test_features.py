"""Edge fixtures E1-E8, E12 and halo = global window properties."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bar_rows, bars_df
from kandela.operators.features import add_features, silver
from kandela.operators.ordered import dense_index, ordered_window


def _by_time(df, cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*[c for c in ("symbol", "open_time") if c in df.columns]).collect()]


@pytest.mark.parametrize("method", ["halo", "global", "edges"])
def test_e1_target_and_moving_averages(spark, method):
    b = bars_df(spark, bar_rows([float(i) for i in range(1, 13)]))
    f = add_features(b, method=method, block_rows=16).orderBy("open_time").collect()
    assert f[0]["close_t_plus_10"] == 11.0 and f[1]["close_t_plus_10"] == 12.0
    assert all(r["close_t_plus_10"] is None for r in f[2:])
    assert f[0]["MA_5"] == 1.0 and f[1]["MA_5"] == 1.5 and f[4]["MA_5"] == 3.0
    assert f[9]["MA_10"] == 5.5
    s = silver(b, method=method, block_rows=16).collect()
    assert len(s) == 1 and s[0]["close"] == 2.0


def test_e2_zero_volume(spark):
    b = bars_df(spark, bar_rows([1.0, 2.0], volume=0.0))
    assert [r.taker_ratio for r in add_features(b).collect()] == [None, None]
    g = add_features(b, ratio_on_zero="zero").collect()
    assert [r.taker_ratio for r in g] == [0.0, 0.0]


def test_e3_zero_previous_close(spark):
    b = bars_df(spark, bar_rows([0.0] + [float(i) for i in range(1, 14)]))
    f = add_features(b).orderBy("open_time").collect()
    assert f[1]["return_1m"] is None          # previous close is 0
    s = silver(b).orderBy("open_time").collect()
    assert [r.close for r in s] == [2.0, 3.0]  # row 1 (first) and row 2 (zero prev) dropped


@pytest.mark.parametrize("n", [0, 1, 5, 11])
def test_e4_short_series_empty_silver(spark, n):
    b = bars_df(spark, bar_rows([float(i + 1) for i in range(n)]))
    assert silver(b).count() == 0


def test_silver_n_minus_11(spark):
    b = bars_df(spark, bar_rows([float(i + 1) for i in range(40)]))
    assert silver(b, block_rows=16).count() == 40 - 11


def test_e5_nan_close_dropped(spark):
    closes = [float(i + 1) for i in range(14)]
    closes[12] = float("nan")  # its target row (index 2) gets NaN
    b = bars_df(spark, bar_rows(closes))
    s = silver(b).collect()
    assert all(not math.isnan(r.close_t_plus_10) for r in s)
    assert all(not math.isnan(r.return_1m) for r in s)


def test_e7_gaps_use_rows(spark):
    b = bars_df(spark, bar_rows([float(i) for i in range(1, 13)], gaps=(3, 7)))
    f = add_features(b).orderBy("open_time").collect()
    assert f[0]["close_t_plus_10"] == 11.0     # 10th row, not 10th minute


def test_e8_symbols_do_not_leak(spark):
    rows = bar_rows([float(i) for i in range(1, 13)], symbol="A") + \
        bar_rows([float(100 + i) for i in range(1, 13)], symbol="B")
    b = bars_df(spark, rows, keyed=True)
    for method in ("halo", "global"):
        f = add_features(b, keys=["symbol"], method=method, block_rows=10).collect()
        for r in f:
            if r.symbol == "A":
                assert r.close < 100 and (r.close_t_plus_10 is None or r.close_t_plus_10 < 100)
                assert r.MA_10 < 100
            else:
                assert r.MA_10 > 100 and (r.return_1m is None or r.return_1m < 1)


def _compare_halo(spark, series, block_rows):
    rows = []
    for s, (n, gaps) in enumerate(series):
        rows += bar_rows([float((7 * i) % 13 + s) for i in range(n)], symbol=f"S{s}",
                         gaps=gaps, start="2024-01-01 23:50:00")
    if not rows:
        return
    b = bars_df(spark, rows, keyed=True)
    cols = ["symbol", "open_time", "close_t_plus_10", "return_1m", "MA_5", "MA_10"]
    h = _by_time(add_features(b, keys=["symbol"], method="halo", block_rows=block_rows), cols)
    g = _by_time(add_features(b, keys=["symbol"], method="global"), cols)
    e = _by_time(add_features(b, keys=["symbol"], method="edges", block_rows=block_rows,
                              bucket_unit="hour"), cols)
    assert h == g
    assert e == g


@pytest.mark.parametrize("B", [10, 16])
def test_e12_halo_equals_global_at_block_edges(spark, B):
    lengths = [1, B - 1, B, B + 1, 2 * B + 9]
    _compare_halo(spark, [(n, ()) for n in lengths], B)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.sets(st.integers(0, 60), max_size=5)),
                min_size=1, max_size=4),
       st.integers(10, 25))
def test_halo_property(spark, series, B):
    _compare_halo(spark, [(n, tuple(g)) for n, g in series], B)


def test_dense_index_is_row_number(spark):
    rows = bar_rows([1.0] * 50, symbol="A", step_minutes=97) + \
        bar_rows([2.0] * 7, symbol="B", step_minutes=600)
    b = bars_df(spark, rows, keyed=True)
    idx = dense_index(b, ["open_time"], ["symbol"], total_col="n").collect()
    by = {}
    for r in idx:
        by.setdefault(r.symbol, []).append((r.open_time, r._i, r.n))
    for s, v in by.items():
        v.sort()
        assert [x[1] for x in v] == list(range(len(v)))
        assert {x[2] for x in v} == {len(v)}


def test_null_time_and_null_key_kept(spark):
    rows = bar_rows([1.0, 2.0, 3.0], symbol=None)
    rows.append(dict(rows[0], open_time=None))
    b = bars_df(spark, [{"symbol": None, **r} for r in rows], keyed=True)
    idx = dense_index(b, ["open_time"], ["symbol"]).orderBy("_i").collect()
    assert [r._i for r in idx] == [0, 1, 2, 3]
    assert idx[0].open_time is None  # NULLs first, as in an ascending window


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_exchange(spark):
    """Keyed: no SinglePartition at all. Unkeyed: only the prefix sum over the
    per-bucket count frame (one row per day) is a single partition; every row
    of data goes through hash-partitioned exchanges."""
    from kandela.plans import fixtures as fx
    b = fx.bronze(spark, "/root/testdata/sf0.001", fx.MINUTE, keyed=True)
    assert "SinglePartition" not in _plan(add_features(b, keys=["symbol"]))
    lines = _plan(add_features(b.drop("symbol"))).splitlines()
    single = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert len(single) == 1
    assert "functions=[count(1)]" in lines[single[0] + 1]


def test_ordered_window_rejects_small_blocks(spark):
    b = bars_df(spark, bar_rows([1.0, 2.0]))
    with pytest.raises(ValueError):
        ordered_window(b, lambda w: {"x": F.lead("close", 10).over(w)}, ["open_time"],
                       fwd=10, block_rows=5)


def test_halo_equals_global_with_duplicate_candles(spark):
    """Full-row duplicates (re-fetched candles) tie on every order column;
    the halo result still equals the global window's."""
    base = bar_rows([float((5 * i) % 11) for i in range(40)], symbol="A")
    rows = base + base[9:14] + base[30:32]       # duplicates around block edges
    b = bars_df(spark, rows, keyed=True)
    cols = ["symbol", "open_time", "close", "close_t_plus_10", "return_1m", "MA_5", "MA_10"]
    srt = lambda df: sorted(tuple(r[c] for c in cols) for r in df.collect())
    h = srt(add_features(b, keys=["symbol"], method="halo", block_rows=10))
    g = srt(add_features(b, keys=["symbol"], method="global"))
    e = srt(add_features(b, keys=["symbol"], method="edges", block_rows=10, bucket_unit="hour"))
    assert h == g and len(h) == len(rows)
    assert e == g


def test_edges_shuffles_the_data_once(spark, tmp_dir):
    """The edge branch reads the main (keys, bucket) exchange again
    (ReusedExchange): the candle data is shuffled once; only edge rows and
    per-bucket counts move again."""
    import os
    from kandela.plans import fixtures as fx
    from kandela.sources.tables import load_bars
    path = os.path.join(tmp_dir, "bronze")
    fx.bronze(spark, "/root/testdata/sf0.001", fx.MINUTE, keyed=True).write.parquet(path)
    df = silver(load_bars(spark, path, keys=["symbol"]), ["symbol"], method="edges")
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "ReusedExchange" in final


def test_dense_index_numeric_order_column(spark):
    """A numeric order column is bucketed by floor(t / n)."""
    df = spark.range(0, 200, 3).select((F.col("id") * 2).alias("t"),
                                       (F.col("id") % 2).cast("string").alias("k"))
    idx = dense_index(df, ["t"], ["k"], bucket_unit=17, total_col="n").collect()
    for k in ("0", "1"):
        rows = sorted((r.t, r._i, r.n) for r in idx if r.k == k)
        assert [r[1] for r in rows] == list(range(len(rows)))
        assert {r[2] for r in rows} == {len(rows)}


def test_methods_agree_with_null_times_and_keys(spark):
    """NULL symbols form their own series and NULL times sort first, as in the
    plain window; halo and edges give the same rows."""
    rows = [{"symbol": None, **r} for r in bar_rows([float(i % 9 + 1) for i in range(30)])] + \
        bar_rows([float(i % 5 + 1) for i in range(25)], symbol="B")
    rows += [dict(rows[3], open_time=None), dict(rows[40], open_time=None)]
    b = bars_df(spark, rows, keyed=True)
    cols = ["symbol", "open_time", "close", "close_t_plus_10", "return_1m", "MA_5", "MA_10"]

    def srt(df):
        return sorted((tuple((v is None, v) for v in (r[c] for c in cols)) for r in df.collect()))
    g = srt(add_features(b, keys=["symbol"], method="global"))
    assert srt(add_features(b, keys=["symbol"], method="halo", block_rows=10)) == g
    assert srt(add_features(b, keys=["symbol"], method="edges", block_rows=10,
                            bucket_unit="hour")) == g
