"""Streaming equals batch on closed windows (S2 vs A15, S3 vs E2)."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")


def test_stream_bars_equal_batch_closed(spark):
    from pyspark.sql import functions as F

    s = entry.queries()["s2_stream_bars"](spark, SF_SMALL)
    b = entry.queries()["a15_resample"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    import datetime as dt

    closed = b.filter(F.col("timestamp") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts - dt.timedelta(minutes=10)))
    assert sorted(s.collect()) == sorted(closed.collect())


def test_stream_signals_equal_backtest(spark):
    s = {(r.symbol, r.timestamp): (r.signal, r.confidence) for r in entry.queries()["s3_stream_signals"](spark, SF_SMALL).collect()}
    b = {(r.symbol, r.timestamp): (r.signal, r.confidence) for r in entry.queries()["e2_backtest"](spark, SF_SMALL).collect()}
    assert s and all(b[k] == v for k, v in s.items())


def _split(df, spark, n):
    """The bars in n runs of time."""
    rows = df.orderBy("timestamp").collect()
    size = -(-len(rows) // n)
    return [spark.createDataFrame(rows[i : i + size], df.schema) for i in range(0, len(rows), size)]


@pytest.mark.parametrize("batches", [3])
def test_rule_is_the_same_for_any_micro_batches(spark, tmp_path, batches):
    """Nulls in the closes, several series, a batch tried again, late and repeated bars."""
    import numpy as np
    from conftest import bars_df
    from tickweave.operators.signals import ema_rsi_backtest
    from tickweave.streaming.bars import RuleStream

    rng = np.random.default_rng(4)
    a = [None if i % 11 == 3 else float(x) for i, x in enumerate(100 + np.cumsum(rng.normal(size=40)))]
    bars = bars_df(spark, a).unionByName(bars_df(spark, a[5:30], symbol="B", start="2024-01-01 10:00:00"))
    rule = RuleStream(spark, str(tmp_path / "rule"))
    parts = _split(bars, spark, batches)
    for epoch, p in enumerate(parts):
        rule.process(p, epoch)
        if epoch == 1:
            rule.process(p, epoch)  # tried again
    late = parts[0].limit(3)
    rule.process(late, len(parts))
    got = {(r.symbol, r.timestamp): (r.signal, r.confidence) for r in rule.signals.read().collect()}
    want = {(r.symbol, r.timestamp): (r.signal, r.confidence) for r in ema_rsi_backtest(bars).collect()}
    assert got.keys() == want.keys() and len(got) == 65
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-9)
    assert rule.late.read().count() == 3
    assert len(rule.state.epochs()) == 2 and rule.state.before(99).count() == 2


def test_late_ticks_correct_closed_bars(spark, tmp_path):
    import datetime as dt

    from tickweave.streaming.bars import CorrectedBars

    t = lambda h, m: dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc)
    frame = lambda rows: spark.createDataFrame(rows, "symbol string, event_time timestamp, price double")
    bars = CorrectedBars(spark, str(tmp_path / "bars"))
    assert bars.bars().count() == 0
    bars.process(frame([("A", t(0, 5), 10.0), ("A", t(0, 50), 12.0), ("A", t(1, 1), 11.0)]), 0)
    bars.process(frame([("A", t(2, 0), 9.0)]), 1)
    bars.process(frame([("A", t(2, 0), 9.0)]), 1)  # tried again: counts once
    for tidy in (False, True):
        bars.process(frame([("A", t(0, 1), 13.0), ("A", t(0, 55), 8.0), ("A", None, 1.0)]), 2)  # closed long ago
        if tidy:
            bars.compact()
            bars.process(frame([("A", t(0, 1), 13.0)]), 2)  # tried again after the compaction
        got = {r.timestamp.hour: (r.open, r.high, r.low, r.close, r.volume, r.ticks) for r in bars.bars().collect()}
        assert got == {0: (13.0, 13.0, 8.0, 8.0, 4.0, 4), 1: (11.0, 11.0, 11.0, 11.0, 1.0, 1), 2: (9.0, 9.0, 9.0, 9.0, 1.0, 1)}
    bars.process(frame([("B", t(0, 1), 1.0)]), 3)
    bars.compact()
    assert bars.bars().count() == 4 and bars.parts.epochs() == [] and bars.base.epochs() == [3]
