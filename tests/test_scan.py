"""The multi-level scan: many super-segments, any segment size, nulls without opting in."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import bars_df
from tickweave.operators import indicators as ind
from tickweave.operators import scan
from tickweave.operators.bars import regularise
from tickweave.operators.carry import carry_stage
from tickweave.operators.ewm import Ema, EmaOfEmas
from tickweave.operators.series import SEGMENT_CONF, index_rows
from tickweave.operators.signals import ema_rsi_backtest


@pytest.fixture
def segments(spark):
    yield lambda n: spark.conf.set(SEGMENT_CONF, str(n))
    spark.conf.unset(SEGMENT_CONF)


def e(x, **k):
    return x.ewm(adjust=False, **k).mean()


@pytest.mark.parametrize("max_block", [None, 2])
def test_states_cross_super_segments(spark, monkeypatch, segments, max_block):
    """Segments of 4 rows, 16 of them in a super-segment, several super-segments: sums, fills, EMAs
    with and without nulls, and the EMA of EMAs equal pandas."""
    monkeypatch.setattr(scan, "FAN", 16)
    segments(4)
    rng = np.random.default_rng(8)
    x = pd.Series(100 + np.cumsum(rng.normal(size=600)))
    holes = x.where(rng.random(600) < 0.4)
    holes[0:9] = np.nan
    holes[200:420] = np.nan
    b = bars_df(spark, [(v, None if pd.isna(h) else h, v, v, 1.0) for v, h in zip(x, holes)])
    d = index_rows(b)
    assert [r["_i"] for r in d.orderBy("timestamp").select("_i").collect()] == list(range(600))
    got = carry_stage(
        d.withColumn("fwd", F.col("high")).withColumn("bwd", F.col("high")).withColumn("both", F.col("high")),
        sums={"total": F.col("close")}, ffill=["fwd"], bfill=["bwd"], fill_chain=["both"], max_block=max_block,
        emas=[Ema.span("e12", "close", 12), Ema.span("e26", "close", 26), Ema("g", "high", 0.3, gaps=True), Ema("one", "high", 1.0, gaps=True), Ema.com("late", "close", 14, start=7)],
        ema_combos=[EmaOfEmas.span("sig", {"e12": 1.0, "e26": -1.0}, 9)],
    ).orderBy("_i").toPandas()
    line = e(x, span=12) - e(x, span=26)
    want = {
        "total": x.cumsum(), "fwd": holes.ffill(), "bwd": holes.bfill(), "both": holes.ffill().bfill(), "e12": e(x, span=12), "e26": e(x, span=26),
        "g": e(holes, alpha=0.3), "one": holes.ffill(), "late": e(x.where(x.index >= 7), alpha=1 / 14), "sig": e(line, span=9),
    }
    for name, series in want.items():
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), series.to_numpy(), rtol=1e-9, atol=1e-11, err_msg=name)


def test_same_shuffles_at_any_segment_size(spark, segments):
    from tools.plan_stats import counts

    rng = np.random.default_rng(1)
    b = bars_df(spark, list(100 + np.cumsum(rng.normal(size=50))))
    found, rows = [], []
    for n in (1024, 4096, 65536):
        segments(n)
        d = ind.indicators(regularise(b, fill="ffill_bfill"), gaps=False)
        found.append(counts(d))
        rows.append(d.drop("_i").orderBy("timestamp").toPandas())
    assert found[0]["shuffle_stages"] == found[1]["shuffle_stages"] == found[2]["shuffle_stages"]
    pd.testing.assert_frame_equal(rows[0], rows[1], rtol=1e-12)
    pd.testing.assert_frame_equal(rows[0], rows[2], rtol=1e-12)


def test_too_many_segments_are_refused(spark, monkeypatch, segments):
    monkeypatch.setattr(scan, "FAN", 2)
    segments(2)
    b = bars_df(spark, [1.0] * 40)
    with pytest.raises(PySparkException, match="raise spark.tickweave.segmentRows"):
        ind.ema(b, gaps=False).collect()


def test_holes_in_the_index_are_refused(spark, segments):
    segments(8)
    d = index_rows(bars_df(spark, [1.0] * 40)).where("_i < 8 or _i > 10")
    with pytest.raises(PySparkException, match="holes"):
        carry_stage(d, emas=[Ema.span("e", "close", 12)], max_block=2).collect()


CLOSES = [None, None, 10, 11, None, 12, 13, 9, None, None, None, 14, 14, None, 8, 9, 10, None, 12, 12.5] * 4


@pytest.mark.parametrize("segment", [16, 1024])
def test_bundle_over_nulls_equals_pandas(spark, segments, segment):
    segments(segment)
    b = bars_df(spark, [(1.0, 2.0, 0.5, c, 5.0) for c in CLOSES])
    got = ind.indicators(b).orderBy("_i").toPandas()
    s = pd.Series(CLOSES, dtype=float)
    d = s.diff()
    up, down = d.clip(lower=0), -d.clip(upper=0)
    rs = e(up, alpha=1 / 14) / e(down, alpha=1 / 14).replace(0, np.nan)
    line = e(s, span=12) - e(s, span=26)
    fill = lambda x: x.ffill().bfill().fillna(0.0)
    want = {"close": s, "ema12": e(s, span=12), "ema26": e(s, span=26), "macd": line, "macd_signal": e(line, span=9), "macd_hist": line - e(line, span=9), "rsi14": (100 - 100 / (1 + rs)).fillna(50)}
    for name, series in want.items():
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), fill(series).to_numpy(), rtol=1e-9, atol=1e-11, err_msg=name)
    raw = ind.indicators(b, fill=False).orderBy("_i").toPandas()
    np.testing.assert_allclose(raw["macd_signal"].to_numpy(dtype=float), want["macd_signal"].to_numpy(), rtol=1e-9, atol=1e-11)
    causal = ind.indicators(b, backfill=False).orderBy("_i").toPandas()
    assert causal["ema12"][0] == 0.0 and causal["ema12"][2] == 10.0
    assert ind.indicators(b.withColumn("close", F.lit(None).cast("double"))).where("ema12 <> 0 or macd <> 0").count() == 0


def test_rule_and_feature_sets_over_nulls(spark):
    b = bars_df(spark, [(1.0, 2.0, 0.5, c, 5.0) for c in CLOSES])
    s = pd.Series(CLOSES, dtype=float)
    bt = ema_rsi_backtest(b, keep_indicators=True).orderBy("_i").toPandas()
    np.testing.assert_allclose(bt["ema26"].to_numpy(dtype=float), e(s, span=26).to_numpy(), rtol=1e-9)
    assert bt["signal"][0] == "NoSignal" and set(bt["signal"]) > {"NoSignal"}
    full = ind.feature_set(b, lags_=(1,), windows=(14,), hourly=(), min_periods=1, target=False).orderBy("_i").toPandas()
    filled = lambda x: x.ffill().bfill()
    np.testing.assert_allclose(full["ema12"].to_numpy(dtype=float), filled(e(s, span=12)).to_numpy(), rtol=1e-9)
    assert ind.zero_filled_features(b).where("ema12 is null or macd_signal is null").count() == 0
    ta = ind.ta_ema(b, "close", 5, "t").orderBy("_i").toPandas()["t"]
    seed = s.copy()
    seed[:4], seed[4] = np.nan, np.nanmean(s[:5])
    np.testing.assert_allclose(ta.to_numpy(dtype=float), e(seed, alpha=2 / 6).to_numpy(), rtol=1e-9)
    assert ind.ta_rsi(b, 5).count() == len(CLOSES)
    assert ind.partial_features(b).count() == len(CLOSES)
