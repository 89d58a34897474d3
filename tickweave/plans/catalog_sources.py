"""Registered queries for sources and sinks.

Each query writes data that Spark derives from the driver tables to a scratch
folder under the session's checkpoint directory (the shared folder a cluster
names in ``spark.checkpoint.dir``), then reads it back with the source
operator under test.  Paths are fixed per query and overwritten.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickweave.functions.core import epoch_us, rounded
from tickweave.operators.indicators import indicators
from tickweave.operators.signals import ema_rsi_backtest
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import _BACKTEST_SQL, _BUNDLE_SQL, KEYS_SQL, out, query, with_bars
from tickweave.plans.inputs import bars_cte, event_bars, table
from tickweave.schema import INDICATOR_COLS, KEYS, KLINE_FIELDS, PRICE_COLS, TS
from tickweave.session import ensure_checkpoint_dir
from tickweave.sources import files as src

ROUND_VALS = ", ".join(q.r(c, c) for c in PRICE_COLS)


def scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tickweave-scratch/{name}"


_TWO_TF = f"""WITH {bars_cte('1h', 'b60')}, {bars_cte('15m', 'b15')},
bars AS (SELECT * FROM b60 UNION ALL SELECT * FROM b15)"""


def _two_timeframes_as_csv(spark, sf, path):
    """1h bars with naive time text, 15m bars with ``+00:00`` offsets."""
    b60 = event_bars(spark, sf, "1h")
    src.write_csv(b60, path + "/naive")
    b15 = event_bars(spark, sf, "15m").withColumn(TS, F.concat(F.date_format(TS, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")))
    src.write_csv(b15, path + "/offset")


@query("a1_csv_scan", f"{_TWO_TF}\nSELECT {KEYS_SQL}, {ROUND_VALS} FROM bars")
def a1_csv_scan(spark, sf):
    """OHLCV CSV written per series folder and read back with an explicit
    schema; both time shapes (naive and ``+00:00``) parse to the same UTC."""
    path = scratch(spark, "a1")
    _two_timeframes_as_csv(spark, sf, path)
    d = src.read_partitioned_csv(spark, path + "/naive").unionByName(src.read_partitioned_csv(spark, path + "/offset"))
    return out(d, PRICE_COLS)


@query(
    "a2_discover_files",
    f"{_TWO_TF}\nSELECT symbol, timestamp, {ROUND_VALS} FROM bars",
)
def a2_discover_files(spark, sf):
    """Recursive discovery under one root that also holds a signal log: the
    log is skipped by name, the series key is taken from the folder name."""
    path = scratch(spark, "a2")
    _two_timeframes_as_csv(spark, sf, path)
    bt = ema_rsi_backtest(event_bars(spark, sf)).select(F.date_format(TS, "yyyy-MM-dd HH:mm:ss").alias("utc_ts"), "symbol", "signal", "confidence")
    bt.coalesce(1).write.mode("overwrite").option("header", True).csv(path + "/signals_csv")
    d = src.read_ohlcv_csv(spark, path)
    return d.select(
        F.regexp_extract("source_file", "symbol=([^/]+)", 1).alias("symbol"), TS, *[rounded(c).alias(c) for c in PRICE_COLS]
    )


@query(
    "a4_parquet_merge_schema",
    f"""{_TWO_TF.replace('bars AS (SELECT * FROM b60 UNION ALL SELECT * FROM b15)', 'bars AS (SELECT *, NULL AS n_hour FROM b60 UNION ALL SELECT *, CAST(hour(timestamp) AS INTEGER) FROM b15)')}
SELECT {KEYS_SQL}, n_hour, {ROUND_VALS} FROM bars""",
)
def a4_parquet_merge_schema(spark, sf):
    """Parquet files with different columns in one tree (a later append adds
    ``n_hour``) read as one table (``mergeSchema``)."""
    path = scratch(spark, "a4")
    src.write_series_parquet(event_bars(spark, sf, "1h"), path)
    src.write_series_parquet(event_bars(spark, sf, "15m").withColumn("n_hour", F.hour(TS)), path, mode="append")
    d = src.read_parquet(spark, path)
    return out(d, PRICE_COLS, ["n_hour"])


@query(
    "a5_parquet_sink",
    with_bars(f"{_BUNDLE_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in (*PRICE_COLS, *INDICATOR_COLS)) + " FROM f"),
)
def a5_parquet_sink(spark, sf):
    """Indicator table written one folder per series, then read back."""
    path = scratch(spark, "a5")
    src.write_series_parquet(indicators(event_bars(spark, sf)).drop("_i"), path)
    return out(src.read_parquet(spark, path), [*PRICE_COLS, *INDICATOR_COLS])


@query("a6_csv_sink", with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt"))
def a6_csv_sink(spark, sf):
    """Backtest report written as CSV and read back."""
    path = scratch(spark, "a6")
    bt = ema_rsi_backtest(event_bars(spark, sf)).select(*KEYS, TS, "signal", "confidence")
    src.write_csv(bt, path, keys=None)
    d = spark.read.schema("symbol string, timeframe string, timestamp string, signal string, confidence double").option("header", True).csv(path)
    return d.select(*KEYS, F.to_timestamp_ntz(TS).alias(TS), "signal", rounded("confidence").alias("confidence"))


@query("a7_append_log", with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt"))
def a7_append_log(spark, sf):
    """Signals appended in two runs (before / after 2024-01-15) to one log."""
    path = scratch(spark, "a7")
    bt = ema_rsi_backtest(event_bars(spark, sf)).select(*KEYS, F.date_format(TS, "yyyy-MM-dd HH:mm:ss").alias(TS), "signal", "confidence")
    bt.limit(0).write.mode("overwrite").option("header", True).csv(path)
    cut = F.col(TS) < F.lit("2024-01-15 00:00:00")
    src.append_log(bt.filter(cut), path)
    src.append_log(bt.filter(~cut), path)
    d = spark.read.schema("symbol string, timeframe string, timestamp string, signal string, confidence double").option("header", True).csv(path)
    return d.select(*KEYS, F.to_timestamp_ntz(TS).alias(TS), "signal", rounded("confidence").alias("confidence"))


@query(
    "a8_predictions_jsonl",
    with_bars(
        f"{_BACKTEST_SQL}\nSELECT timeframe AS horizon, timestamp, CASE signal WHEN 'BUY' THEN 1 ELSE 0 END AS pred, "
        "round(CASE signal WHEN 'BUY' THEN confidence WHEN 'SELL' THEN 1.0 - confidence ELSE 0.5 END, 6) + 0.0 AS prob FROM bt"
    ),
)
def a8_predictions_jsonl(spark, sf):
    """Prediction rows (horizon, time, class, probability) as JSON lines."""
    path = scratch(spark, "a8")
    bt = ema_rsi_backtest(event_bars(spark, sf))
    p = bt.select(
        F.col("timeframe").alias("horizon"),
        TS,
        (F.col("signal") == "BUY").cast("long").alias("pred"),
        F.when(F.col("signal") == "BUY", F.col("confidence")).when(F.col("signal") == "SELL", 1.0 - F.col("confidence")).otherwise(F.lit(0.5)).alias("prob"),
    )
    src.write_predictions(p, path, mode="overwrite")
    d = src.read_predictions(spark, path)
    return d.select("horizon", TS, "pred", rounded("prob").alias("prob"))


@query("a9_kline_normalise", with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, {ROUND_VALS} FROM o"))
def a9_kline_normalise(spark, sf):
    """Bars as 12-field exchange klines (epoch-ms, numbers as text), landed
    as JSON lines, then normalised back to OHLCV."""
    path = scratch(spark, "a9")
    b = event_bars(spark, sf)
    ms = (epoch_us(b, TS) / 1000).cast("long")
    wide = b.select(
        "symbol",
        ms.cast("string").alias("timestamp"),
        *[F.col(c).cast("string").alias(c) for c in PRICE_COLS],
        (ms + 3_600_000 - 1).cast("string").alias("close_time"),
        (F.col("close") * F.col("volume")).cast("string").alias("quote_asset_volume"),
        F.col("volume").cast("long").cast("string").alias("number_of_trades"),
        F.lit("0").alias("taker_buy_base_asset_volume"),
        F.lit("0").alias("taker_buy_quote_asset_volume"),
        F.lit("0").alias("ignore"),
    )
    wide.write.mode("overwrite").partitionBy("symbol").json(path)
    raw = spark.read.schema(src.KLINE_SCHEMA.add("symbol", "string")).json(path)
    assert set(KLINE_FIELDS) <= set(raw.columns)
    return out(src.normalise_klines(raw, "symbol", "1h"), PRICE_COLS)


def _fmt8(c):
    return F.format_string("%.8f", c)


@query(
    "a10_trade_fills",
    """WITH f AS (
  SELECT o.o_orderpriority AS symbol,
    CAST(printf('%.8f', l.l_extendedprice / l.l_quantity) AS DECIMAL(18,8)) AS price,
    CAST(printf('%.8f', l.l_quantity) AS DECIMAL(18,8)) AS qty,
    CAST(printf('%.8f', l.l_extendedprice * 0.001) AS DECIMAL(18,8)) AS commission
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT symbol, count(*) AS n_fills, CAST(sum(qty) AS DOUBLE) AS qty, CAST(CAST(sum(CAST(qty AS DECIMAL(38,8)) * CAST(price AS DECIMAL(38,8))) AS DECIMAL(38,8)) AS DOUBLE) AS notional,
  CAST(sum(commission) AS DOUBLE) AS commission FROM f GROUP BY symbol""",
)
def a10_trade_fills(spark, sf):
    """Each order becomes one trade-log row whose ``info`` JSON holds its
    line items as fills; the CSV is read back, the JSON parsed, fills
    exploded and summed per symbol (the order priority)."""
    path = scratch(spark, "a10")
    li = table(spark, sf, "lineitem")
    od = table(spark, sf, "orders")
    fills = li.select(
        "l_orderkey",
        F.struct(
            _fmt8(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            _fmt8(F.col("l_quantity")).alias("qty"),
            _fmt8(F.col("l_extendedprice") * 0.001).alias("commission"),
            F.lit("USDT").alias("commissionAsset"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("tradeId"),
        ).alias("fill"),
    )
    # One order has a handful of line items: a bounded group per key.
    per_order = fills.groupBy("l_orderkey").agg(F.collect_list("fill").alias("fills"), F.count(F.lit(1)).alias("n"))
    trades = od.join(per_order, od.o_orderkey == per_order.l_orderkey).select(
        F.lit(0.0).alias("amount"),
        F.lit(0.0).alias("remaining"),
        F.when(F.col("o_orderstatus") == "O", "buy").otherwise("sell").alias("side"),
        F.lit(0.0).alias("filled"),
        F.to_json(
            F.struct(
                F.col("o_orderpriority").alias("symbol"),
                F.col("o_orderkey").cast("string").alias("orderId"),
                F.lit("x").alias("clientOrderId"),
                F.lit("0").alias("transactTime"),
                F.lit("0").alias("price"),
                F.lit("0").alias("origQty"),
                F.lit("0").alias("executedQty"),
                F.lit("0").alias("cummulativeQuoteQty"),
                F.lit("FILLED").alias("status"),
                F.lit("GTC").alias("timeInForce"),
                F.lit("MARKET").alias("type"),
                F.lit("BUY").alias("side"),
                F.lit("0").alias("workingTime"),
                F.col("fills"),
            )
        ).alias("info"),
        F.lit("closed").alias("status"),
        F.col("o_orderpriority").alias("symbol"),
        F.floor(epoch_us(od, "o_orderdate") / 1000).alias("timestamp"),
        F.lit("market").alias("type"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"),
    )
    trades.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return src.fill_totals(src.read_trade_fills(spark, path))


@query(
    "a11_ragged_signal_log",
    with_bars(
        f"""{_BACKTEST_SQL}
SELECT timestamp AS utc_ts, CASE WHEN timestamp >= TIMESTAMP '2024-01-15' THEN timestamp + INTERVAL 3 HOUR END AS local_ts,
  symbol AS pair, CASE WHEN timestamp >= TIMESTAMP '2024-01-15' THEN timeframe END AS timeframe,
  CASE WHEN signal = 'NoSignal' THEN NULL ELSE signal END AS signal, {q.r('confidence', 'confidence')}, false AS bad FROM bt"""
    ),
)
def a11_ragged_signal_log(spark, sf):
    """Signal log text: rows before 2024-01-15 in the old 4-field layout,
    later rows in the 6-field layout (empty signal = none); read back into
    one schema."""
    path = scratch(spark, "a11")
    bt = ema_rsi_backtest(event_bars(spark, sf))
    t = F.date_format(TS, "yyyy-MM-dd HH:mm:ss")
    sig_txt = F.when(F.col("signal") == "NoSignal", F.lit("")).otherwise(F.col("signal"))
    conf = F.col("confidence").cast("string")
    line = F.when(
        F.col(TS) < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"),
        F.concat_ws(",", t, F.col("symbol"), sig_txt, conf),
    ).otherwise(F.concat_ws(",", t, F.date_format(F.col(TS) + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.col("symbol"), F.col("timeframe"), sig_txt, conf))
    bt.select(line.alias("value")).write.mode("overwrite").text(path)
    d = src.read_signal_log(spark, path)
    return d.select("utc_ts", "local_ts", "pair", "timeframe", "signal", rounded("confidence").alias("confidence"), "bad")


@query(
    "a12_signal_log_lines",
    with_bars(f"{_BACKTEST_SQL}\nSELECT timestamp AS log_time, symbol AS pair, signal AS action, round(confidence, 2) + 0.0 AS confidence FROM bt"),
)
def a12_signal_log_lines(spark, sf):
    """Signals formatted as run-log lines, mixed with unrelated log lines,
    then parsed back (the unrelated lines are ignored)."""
    path = scratch(spark, "a12")
    bt = ema_rsi_backtest(event_bars(spark, sf))
    lines = bt.select(src.format_signal_line(F.col(TS), F.col("symbol"), F.col("signal"), F.col("confidence")).alias("value"))
    noise = bt.select(F.format_string("%s,000 - INFO - heartbeat %s", F.date_format(TS, "yyyy-MM-dd HH:mm:ss"), F.col("symbol")).alias("value"))
    lines.unionByName(noise).write.mode("overwrite").text(path)
    d = src.parse_signal_lines(spark.read.text(path))
    return d.select("log_time", "pair", "action", rounded("confidence").alias("confidence"))


@query(
    "a14_incremental_load",
    with_bars(
        f"""hw AS (SELECT symbol, timeframe, max(timestamp) AS hw FROM bars WHERE timestamp < TIMESTAMP '2024-01-20' GROUP BY 1, 2)
SELECT b.symbol, b.timeframe, b.timestamp, {", ".join(q.r('b.' + c, c) for c in PRICE_COLS)}
FROM bars b LEFT JOIN hw USING (symbol, timeframe) WHERE hw.hw IS NULL OR b.timestamp > hw.hw"""
    ),
)
def a14_incremental_load(spark, sf):
    """Stored bars end before 2024-01-20; a new landing holds all bars; only
    rows after each series' stored high-water mark are loaded."""
    b = event_bars(spark, sf)
    existing = b.filter(F.col(TS) < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return out(src.incremental_rows(existing, b), PRICE_COLS)
