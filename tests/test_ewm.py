"""EMA blocked scan equals the plain recursion (pandas ewm, adjust=False)."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import bars_df
from tickweave.operators.ewm import Ema, block_rows, ewm
from tickweave.operators.series import index_rows


def _run(spark, closes, specs, max_block=None, seg_rows=1024):
    d = index_rows(bars_df(spark, list(closes)))
    return ewm(d, specs, max_block=max_block, seg_rows=seg_rows).orderBy("_i").toPandas()


@pytest.mark.parametrize("max_block", [None, 4, 16])
def test_ema_matches_recursion(spark, max_block):
    rng = np.random.default_rng(7)
    x = 100 + np.cumsum(rng.normal(size=300))
    out = _run(spark, x, [Ema.span("e12", "close", 12), Ema.span("e26", "close", 26), Ema("e8", "close", 0.8)], max_block, seg_rows=64)
    s = pd.Series(x)
    for name, exp in {"e12": s.ewm(span=12, adjust=False).mean(), "e26": s.ewm(span=26, adjust=False).mean(), "e8": s.ewm(alpha=0.8, adjust=False).mean()}.items():
        np.testing.assert_allclose(out[name].to_numpy(), exp.to_numpy(), rtol=1e-12)


def test_ema_seed_after_leading_null(spark):
    """RSI averages seed on the first diff (row 1), not on a zero in row 0."""
    x = [10, 11, 9, 12, 12, 13]
    d = index_rows(bars_df(spark, x))
    from pyspark.sql import functions as F

    d = d.withColumn("dx", F.when(F.col("_i") > 0, F.col("close") - 1.0))
    out = ewm(d, [Ema.com("a", "dx", 14, start=1)]).orderBy("_i").toPandas()
    exp = pd.Series([None] + [v - 1.0 for v in x[1:]], dtype=float).ewm(alpha=1 / 14, adjust=False).mean()
    assert pd.isna(out["a"][0])
    np.testing.assert_allclose(out["a"][1:].to_numpy(), exp[1:].to_numpy(), rtol=1e-12)


def test_block_rows():
    b = block_rows(2 / 13, 1024)
    assert b == 1024 and 1024 % b == 0
    assert block_rows(0.8, 1024) < 1024


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=1, max_value=1e4, allow_nan=False), min_size=1, max_size=80), st.sampled_from([2, 8, 32]))
def test_block_size_does_not_matter(spark, xs, block):
    a = _run(spark, xs, [Ema.span("e", "close", 9)], None, seg_rows=32)["e"].to_numpy()
    b = _run(spark, xs, [Ema.span("e", "close", 9)], block, seg_rows=32)["e"].to_numpy()
    np.testing.assert_allclose(a, b, rtol=1e-11)


def test_long_zero_run_keeps_tiny_values(spark):
    """6,000 equal closes between moves: the Wilder loss average decays to
    ~1e-190 and must not become 0 (RSI would flip from ~100 to 50)."""
    from tickweave.operators.indicators import rsi_wilder

    x = [100.0, 99.0] + [99.0] * 6000 + [100.0]
    d = index_rows(bars_df(spark, x))
    out = rsi_wilder(d, max_block=128).orderBy("_i").toPandas()["rsi14"].to_numpy()
    s = pd.Series(x)
    delta = s.diff()
    up, down = delta.clip(lower=0), -delta.clip(upper=0)
    rs = up.ewm(alpha=1 / 14, adjust=False).mean() / down.ewm(alpha=1 / 14, adjust=False).mean().replace(0, np.nan)
    exp = (100 - 100 / (1 + rs)).fillna(50).to_numpy()
    np.testing.assert_allclose(out, exp, rtol=1e-9)
    assert out[-1] > 99.0


def test_segment_size_does_not_matter(spark):
    """Indicator bundle and filled grid are the same with 64-row segments
    (many segments, halos and carries) as with the default."""
    import numpy as np
    from pyspark.sql import functions as F

    from tickweave.operators.bars import regularise
    from tickweave.operators.indicators import indicators
    from tickweave.operators.series import SEGMENT_CONF

    rng = np.random.default_rng(11)
    x = list(100 + np.cumsum(rng.normal(size=400)))
    b = bars_df(spark, [(v, v + 1, v - 1, v, 1.0 + (i % 7)) for i, v in enumerate(x)])
    b = b.filter(F.hour("timestamp") != 5)  # gaps for the grid

    def run():
        d = indicators(regularise(b, fill="ffill_bfill")).drop("_i")
        return d.orderBy("symbol", "timestamp").toPandas()

    base = run()
    spark.conf.set(SEGMENT_CONF, "64")
    try:
        small = run()
    finally:
        spark.conf.unset(SEGMENT_CONF)
    pd.testing.assert_frame_equal(base, small, rtol=1e-12)


@pytest.mark.parametrize("seg", ["1024", "64"])
def test_macd_signal_in_one_stage(spark, seg):
    """The EMA of (ema12 - ema26) solved inside the same carry stage equals
    the recursion on the recursion."""
    from tickweave.operators.carry import carry_stage
    from tickweave.operators.ewm import EmaOfEmas
    from tickweave.operators.series import SEGMENT_CONF

    rng = np.random.default_rng(5)
    x = 100 + np.cumsum(rng.normal(size=1500))
    spark.conf.set(SEGMENT_CONF, seg)
    try:
        d = index_rows(bars_df(spark, list(x)))
        out = carry_stage(d, emas=[Ema.span("e12", "close", 12), Ema.span("e26", "close", 26)],
                          ema_combos=[EmaOfEmas.span("sig", {"e12": 1.0, "e26": -1.0}, 9)]).orderBy("_i").toPandas()
    finally:
        spark.conf.unset(SEGMENT_CONF)
    s = pd.Series(x)
    sig = (s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()).ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(out["sig"].to_numpy(), sig.to_numpy(), rtol=1e-9, atol=1e-11)


@pytest.mark.parametrize("alpha", [1.0, 0.9, 0.4])
def test_gap_longer_than_the_carry_window(spark, alpha):
    """More null blocks than the carry reaches back over keep the average (not 0)."""
    from tickweave.operators.ewm import ewm_gaps

    rng = np.random.default_rng(3)
    x = [None] * 9 + [float(v) for v in 100 + rng.normal(size=30)] + [None] * 900 + [float(v) for v in 50 + rng.normal(size=20)] + [None] * 3
    d = index_rows(bars_df(spark, x))
    out = ewm_gaps(d, [Ema("e", "close", alpha), Ema("f", "high", 0.9)], seg_rows=4).orderBy("_i").toPandas()
    for name, a in (("e", alpha), ("f", 0.9)):
        want = pd.Series(x, dtype=float).ewm(alpha=a, adjust=False).mean().to_numpy()
        np.testing.assert_allclose(out[name].to_numpy(dtype=float), want, rtol=1e-9)
