"""Inputs the driver tables never hold: odd timeframes, missing times, gaps, other classes."""

import datetime as dt

import pandas as pd
import pytest
from conftest import bars_df
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickweave.operators import indicators as ind
from tickweave.operators import labels as lab
from tickweave.operators import metrics as met
from tickweave.operators.bars import regularise, ticks_to_bars
from tickweave.operators.series import index_rows
from tickweave.sources.files import parse_time_text
from tickweave.streaming.learn import _POISSON1_CDF


def test_regularise_keeps_series_without_a_grid(spark):
    b = bars_df(spark, [1, 2, 3]).unionByName(bars_df(spark, [4, 5, 6], "B").withColumn("timeframe", F.lit("2h")))
    b = b.filter("not (symbol = 'A' and close = 2)")
    got = regularise(b, fill="ffill").orderBy("symbol", "_i").collect()
    assert [(r["symbol"], r["_i"], r["close"]) for r in got] == [("A", 0, 1), ("A", 1, 1), ("A", 2, 3), ("B", 0, 4), ("B", 1, 5), ("B", 2, 6)]


@pytest.mark.parametrize("column", ["timestamp", "symbol"])
def test_rows_without_time_or_key_fail_clearly(spark, column):
    b = bars_df(spark, [1, 2, 3])
    b = b.withColumn(column, F.when(F.col("close") != 2, F.col(column)))
    with pytest.raises(PySparkException, match="no timestamp or no series key"):
        index_rows(b).collect()


def test_time_text_with_fraction_and_offset(spark):
    texts = ["2025-10-10 05:42:33.123456+00:00", "2025-10-10T05:42:33.5+02:00", "2025-10-10 05:42:33+00:00", "2025-10-10 05:42:33", "2025-10-10T05:42:33Z", "no time"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_time_text(F.col("t"))).collect()]
    day = dt.datetime(2025, 10, 10)
    at = lambda *x: day.replace(**dict(zip(("hour", "minute", "second", "microsecond"), x)))
    assert got == [at(5, 42, 33, 123456), at(3, 42, 33, 500000), at(5, 42, 33), at(5, 42, 33), at(5, 42, 33), None]


def test_ternary_label_takes_default_settings(spark):
    got = lab.ternary_label(bars_df(spark, [100 + i for i in range(10)], timeframe="4h")).orderBy("_i").collect()
    assert [r["label"] for r in got] == [1] * 6 + [0] * 4


def test_confusion_is_the_full_square(spark):
    d = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 2), (1, None)], "y int, pred int")
    assert sorted(map(tuple, met.confusion(d).collect())) == [(0, 1, 0, 1), (1, 0, 1, 1), (2, 0, 0, 0)]


def test_scores_of_any_range(spark):
    d = spark.createDataFrame([(i % 3 == 0, 1000.0 * i - 5e4) for i in range(100)], "b boolean, score double").select(F.col("b").cast("int").alias("y"), "score")
    pos = [i for i in range(100) if i % 3 == 0]
    neg = [i for i in range(100) if i % 3]
    want = sum((p > n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert met.roc_auc(d).first()["roc_auc"] == pytest.approx(want)
    assert met.pr_curve(d).count() == 100


def test_ticks_of_equal_time_do_not_depend_on_order(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("A", t, p) for p in (3.0, 1.0, 2.0)]
    for r in (rows, rows[::-1]):
        got = ticks_to_bars(spark.createDataFrame(r, "symbol string, ts timestamp_ntz, price double"), "1h").first()
        assert (got["open"], got["close"]) == (1.0, 3.0)


@pytest.mark.parametrize("segment", ["4", "1024"])
def test_ema_with_gaps_equals_pandas(spark, segment):
    closes = [None, 10, 11, None, 12, 13, 9, None, None, None, 14, 14, None, 8, 9, 10, None]
    spark.conf.set("spark.tickweave.segmentRows", segment)
    try:
        b = bars_df(spark, closes)
        got = ind.macd(b, gaps=True).orderBy("_i").toPandas()
        s = pd.Series(closes, dtype=float)
        e = lambda x, **k: x.ewm(adjust=False, **k).mean()
        line = e(s, span=12) - e(s, span=26)
        fast = ind.ema_alpha(b, "close", 0.4, "fast", gaps=True).orderBy("_i").toPandas()["fast"]
        for have, want in ((got["macd"], line), (got["macd_signal"], e(line, span=9)), (fast, e(s, alpha=0.4))):
            pd.testing.assert_series_equal(have.astype(float), want, check_names=False, rtol=1e-9)
        with pytest.raises(PySparkException, match="input has a null"):
            ind.ema(b, span=12, gaps=False).collect()
    finally:
        spark.conf.unset("spark.tickweave.segmentRows")


def test_poisson_table_reaches_the_end_of_doubles():
    assert len(_POISSON1_CDF) > 15 and _POISSON1_CDF[-1] == pytest.approx(1.0, abs=1e-15)


def test_checkpoint_folder_is_never_local_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tickweave.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
