"""The grid of B5: long series, stray times, duplicates."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import bars_df
from tickweave.operators.bars import chunk_table, regularise


@pytest.mark.parametrize("last", [0, 7, 8, 63, 64, 500])
def test_chunks_are_complete(spark, last):
    spans = spark.createDataFrame([("A", last), ("B", 3)], "symbol string, _n long")
    got = chunk_table(spans, "_n", 8, fan=4).where("symbol = 'A'") if last < 512 else None
    assert sorted(r["_c"] for r in got.collect()) == list(range(last // 8 + 1))


def test_a_long_series_needs_no_long_array(spark):
    """1e8 slots: 97,657 chunks, from arrays of at most 1,024 places and over many tasks."""
    spans = spark.createDataFrame([("A", 10**8)], "symbol string, _n long")
    d = chunk_table(spans, "_n", 1024)
    r = d.withColumn("p", F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("_c").alias("top"), F.countDistinct("_c").alias("k"), F.countDistinct("p").alias("parts")).first()
    assert (r["n"], r["top"], r["k"]) == (97_657, 97_656, 97_657) and r["parts"] > 1
    with pytest.raises(PySparkException, match="chunks"):
        chunk_table(spans, "_n", 1024, fan=16).collect()


def test_a_stray_time_is_refused(spark):
    stray = bars_df(spark, [1.0], timeframe="1m", start="1970-01-01 00:00:00").unionByName(bars_df(spark, [1.0, 2.0, 3.0], timeframe="1m"))
    with pytest.raises(PySparkException, match="A/1m has 28401122 slots for 4 bars"):
        regularise(stray).collect()
    few = bars_df(spark, [1.0], timeframe="1d", start="1990-01-01 00:00:00").unionByName(bars_df(spark, [2.0], timeframe="1d"))
    assert regularise(few).count() == (dt.date(2024, 1, 1) - dt.date(1990, 1, 1)).days + 1  # rare, but a small grid


def test_duplicate_bars_are_refused(spark):
    b = bars_df(spark, [(1.0, 9.0, 1.0, 5.0, 1.0), (2.0, 3.0, 2.0, 2.5, 1.0)])
    twice = b.unionByName(b.limit(1).withColumn("close", F.lit(7.0)))
    with pytest.raises(PySparkException, match="A/1h has several bars at one time"):
        regularise(twice, fill="ffill").collect()
    off = b.unionByName(b.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 5 MINUTES")))
    assert regularise(off).count() == 2  # off the grid: dropped
