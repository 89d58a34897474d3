"""Hand-made edge series (FIXTURES.md section 4)."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import bars_df
from tickweave.operators import clean, labels
from tickweave.operators.bars import dedup_keep_first, regularise, resample_bars
from tickweave.operators.clean import union_all
from tickweave.operators.indicators import fill_chain, indicators, rsi_ema, rsi_wilder, rolling_stdev, vwap
from tickweave.operators.signals import ema_rsi_backtest
from tickweave.schema import PRICE_COLS


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("timestamp").collect()]


def test_one_row(spark):
    b = bars_df(spark, [10.0])
    out = indicators(b).collect()[0]
    assert out["rsi14"] == 50.0 and out["return1"] == 0.0 and out["ema12"] == 10.0
    assert rolling_stdev(b, "close", 14, 1).collect()[0]["rolling_std_14"] is None
    assert labels.next_bar_up(b, last_row="drop").count() == 0


def test_flat_series(spark):
    b = bars_df(spark, [5.0] * 40)
    assert {r[0] for r in rows(rsi_wilder(b), "rsi14")} == {50.0}
    r = rows(rsi_ema(b), "rsi")
    assert all(v[0] is None for v in r)
    assert {v[0] for v in rows(ema_rsi_backtest(b), "signal")} == {"NoSignal"}
    assert {v[0] for v in rows(rolling_stdev(b, "close", 14, None), "rolling_std_14")[13:]} == {0.0}


def test_only_up_and_down(spark):
    up = bars_df(spark, list(range(1, 41)))
    assert rows(rsi_wilder(up), "rsi14")[-1][0] == 50.0  # no losses: 50 (zero-guarded)
    assert rows(rsi_ema(up), "rsi")[-1][0] == 100.0      # u / 0 -> 100
    down = bars_df(spark, list(range(40, 0, -1)))
    assert rows(rsi_wilder(down), "rsi14")[-1][0] == pytest.approx(0.0, abs=1e-9)
    assert rows(rsi_ema(down), "rsi")[-1][0] == pytest.approx(0.0, abs=1e-9)


def test_zero_volume_vwap(spark):
    data = [(10 + i, 11 + i, 9 + i, 10 + i, 0.0 if 5 <= i < 25 else 3.0) for i in range(40)]
    b = bars_df(spark, data)
    v = [r[0] for r in rows(vwap(b), "vwap14")]
    assert v[18] is None and v[4] is not None  # 14 zero-volume bars: 0/0 -> null, no error
    filled = [r["vwap14"] for r in indicators(b).orderBy("timestamp").collect()]
    assert all(x is not None for x in filled) and filled[18] == filled[17]


def test_gaps_and_off_grid(spark):
    b = bars_df(spark, [1, 2, 3, 4, 5, 6])
    b = b.filter(~F.hour("timestamp").isin(2, 3))
    off = bars_df(spark, [99], start="2024-01-01 01:30:00")
    g = regularise(union_all([b, off]))
    got = rows(g, "close")
    assert [x[0] for x in got] == [1.0, 2.0, None, None, 5.0, 6.0]  # off-grid bar dropped
    f = fill_chain(g, list(PRICE_COLS))
    assert [x[0] for x in rows(f, "close")] == [1.0, 2.0, 2.0, 2.0, 5.0, 6.0]


def test_duplicates_keep_first_file(spark):
    a = bars_df(spark, [1, 2, 3]).withColumn("src", F.lit("file_a"))
    b = bars_df(spark, [7, 8, 9]).withColumn("src", F.lit("file_b"))
    d = dedup_keep_first(union_all([b, a]), ["src"])
    assert [x[0] for x in rows(d, "close")] == [1.0, 2.0, 3.0]


def test_two_series_do_not_leak(spark):
    a = bars_df(spark, list(range(1, 31)), symbol="A")
    b = bars_df(spark, list(range(100, 70, -1)), symbol="B")
    both = indicators(union_all([a, b])).drop("_i")
    alone = indicators(a).drop("_i")
    x = both.filter(F.col("symbol") == "A").orderBy("timestamp").toPandas()
    y = alone.orderBy("timestamp").toPandas()
    pd.testing.assert_frame_equal(x.reset_index(drop=True), y.reset_index(drop=True))


def test_short_series_min_history(spark):
    a = bars_df(spark, list(range(1, 8)), symbol="A")
    b = bars_df(spark, list(range(1, 30)), symbol="B")
    kept = clean.min_history(union_all([a, b]), 5 + 3)
    assert {r[0] for r in kept.select("symbol").distinct().collect()} == {"B"}


def test_bad_values(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (None,)], "x string")
    out = [r[0] for r in clean.coerce_numeric(df, ["x"]).collect()]
    assert out == [1.5, 0.0, 0.0, 0.0]


def test_ties_auc_and_best_threshold(spark):
    from tickweave.operators.metrics import best_f1_threshold, roc_auc

    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2), (1, 0.2), (0, 0.1)], "y int, score double")
    auc = roc_auc(df).collect()[0]["roc_auc"]
    pos, neg = [0.8, 0.6, 0.2], [0.8, 0.2, 0.1]
    exp = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 9
    assert auc == pytest.approx(exp)
    r = best_f1_threshold(df).collect()[0]
    assert r["best_f1"] == pytest.approx(max(2 * p * rc / (p + rc + 1e-12) for p, rc in [(1 / 2, 1 / 3), (2 / 3, 2 / 3), (3 / 5, 1.0), (3 / 6, 1.0)]))


def test_15m_gets_its_own_label_settings(spark):
    closes = [100.0] + [100.1] * 20
    b = bars_df(spark, closes, timeframe="15m")
    lab = [r[0] for r in rows(labels.ternary_label(b), "label")]
    assert lab[0] == 0  # 0.1 % < 15m threshold 0.15 %; under the 5m rule it would be 1
    b5 = bars_df(spark, closes, timeframe="5m")
    assert [r[0] for r in rows(labels.ternary_label(b5), "label")][0] == 1


def test_resample_conserves_volume(spark):
    b = bars_df(spark, [(1, 2, 0.5, 1.5, 2.0)] * 120, timeframe="1m")
    r = resample_bars(b, "1h")
    assert r.agg(F.sum("volume")).first()[0] == pytest.approx(240.0)
    assert r.count() == 2


def test_align_features_idempotent(spark):
    b = bars_df(spark, [1, 2, 3])
    feats = ["close", "missing", "open"]
    once = clean.align_features(b, feats, keep=["timestamp"])
    twice = clean.align_features(once, feats, keep=["timestamp"])
    assert once.collect() == twice.collect() and once.columns == ["timestamp", *feats]
    assert all(r["missing"] == 0.0 for r in once.collect())


def test_backtest_is_causal(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = list(100 + np.cumsum(rng.normal(size=120)))
    full = ema_rsi_backtest(bars_df(spark, x)).orderBy("timestamp").toPandas()
    part = ema_rsi_backtest(bars_df(spark, x[:70])).orderBy("timestamp").toPandas()
    pd.testing.assert_frame_equal(full.iloc[:70][["signal", "confidence"]].reset_index(drop=True), part[["signal", "confidence"]].reset_index(drop=True))


def test_local_halo_equals_shuffled_halo(spark):
    """``partitioned=True`` (halo joined in per segment) gives the same rows
    as the shuffled halo, across many segments."""
    import numpy as np

    from tickweave.operators import indicators as ind
    from tickweave.operators.series import SEGMENT_CONF

    rng = np.random.default_rng(1)
    x = list(100 + np.cumsum(rng.normal(size=300)))
    bars = union_all([bars_df(spark, [(v, v + 1, v - 1, v, 1.0 + i % 5) for i, v in enumerate(x)], symbol=s) for s in ("A", "B")])
    bars = bars.filter(F.hour("timestamp") != 3)
    spark.conf.set(SEGMENT_CONF, "32")
    try:
        g = regularise(bars, fill="ffill_bfill")
        a = ind.indicators(g, next_close=True).orderBy("symbol", "_i").toPandas()
        b = ind.indicators(g, next_close=True, partitioned=True).orderBy("symbol", "_i").toPandas()
    finally:
        spark.conf.unset(SEGMENT_CONF)
    pd.testing.assert_frame_equal(a, b)
