"""Inputs the registered queries share: bars built from the driver tables.

The test tables hold no OHLCV data, so bars are built from ``events``:
``symbol = event_type``, one bucket per timeframe, ``open``/``close`` the
first/last ``value`` by ``ts``, ``high``/``low`` the max/min, ``volume`` the
event count.  ``ts`` is unique, so open/close are well defined.  The same
bars are written once in DuckDB SQL (``bars_cte``) for the oracle.

``lineitem`` gives a much larger, gappy set of daily bars for the bench:
``symbol = l_suppkey``, price ``l_extendedprice / l_quantity``, volume the
quantity; a hash of the whole line fixes the order of the items of one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.operators.bars import ticks_to_bars
from tickweave.schema import TIMEFRAMES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", "value")
    return ticks_to_bars(ev, timeframe, symbol="symbol", ts="ts", price="value", order="ts")  # event times are unique


def lineitem_bars(spark: SparkSession, sf_dir: str, timeframe: str = "1d") -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_shipdate").alias("ts"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("_ord"),
    )
    if timeframe != "1d":
        raise ValueError("lineitem bars are daily: every item of a day shares one ship date")
    # All items of a daily bucket share the ship date and (order key, line)
    # repeats, so the items of a day take a fixed order from a hash of the
    # whole line: deterministic, and an atomic key keeps the aggregate hashed.
    return ticks_to_bars(li, timeframe, symbol="symbol", ts="ts", price="price", volume="qty", order="_ord")


_BUCKET_SQL = {
    "1m": "date_trunc('minute', ts)",
    "1h": "date_trunc('hour', ts)",
    "1d": "date_trunc('day', ts)",
}


def bucket_sql(timeframe: str) -> str:
    if timeframe in _BUCKET_SQL:
        return _BUCKET_SQL[timeframe]
    return f"time_bucket(INTERVAL '{TIMEFRAMES[timeframe]} seconds', ts, TIMESTAMP '1970-01-01')"


def bars_cte(timeframe: str = "1h", name: str = "bars") -> str:
    """DuckDB text of ``event_bars`` as a CTE body: ``name AS (...)``."""
    return f"""{name} AS (
  SELECT event_type AS symbol, '{timeframe}' AS timeframe, {bucket_sql(timeframe)} AS timestamp,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2, 3)"""
