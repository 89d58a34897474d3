"""File sources and sinks.

Readers always pass an explicit schema (no inference pass over the data) and
return the canonical column names; writers partition by the series key so
later reads prune by directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.core import epoch_us, from_epoch_us, tf_seconds
from tickweave.schema import KEYS, KLINE_FIELDS, PRICE_COLS, TS

# File names skipped by discovery (signal logs, reports).
SKIP_NAME_PARTS = ("signals", "unknown", "manifest", "quality_summary")

_RAW_OHLCV = T.StructType(
    [T.StructField("timestamp", T.StringType(), True)] + [T.StructField(c, T.StringType(), True) for c in PRICE_COLS]
)


def parse_time_text(c: Column) -> Column:
    """Naive text (UTC wall clock) or text with a zone offset to ``timestamp_ntz`` UTC."""
    has_zone = c.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    instant = c.try_cast("timestamp")  # the offset in the text fixes the instant, with or without a fraction
    naive = c.try_cast("timestamp_ntz")  # wall clock as written, no session zone
    return F.when(has_zone, from_epoch_us(F.unix_micros(instant))).otherwise(naive)


def read_ohlcv_csv(spark: SparkSession, path: str, recursive: bool = True, skip: Sequence[str] = SKIP_NAME_PARTS) -> DataFrame:
    """A1 + A2: every OHLCV CSV under ``path``.

    Recursive lookup of ``*.csv``; files whose path below ``path`` contains
    one of ``skip`` are left out (signal logs, manifests).  Times may be naive or carry an
    offset; numbers that do not parse become null (``try_cast``).  Adds
    ``source_file``.  Directory partitions (``symbol=..``) are kept when the
    files were written partitioned.
    """
    r = spark.read.schema(_RAW_OHLCV).option("header", True).option("pathGlobFilter", "*.csv")
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.csv(path).withColumn("source_file", F.col("_metadata.file_path"))
    # Match on the path below the root: Spark-written logs keep the name on
    # their folder, hand-written ones on the file.
    rel = F.lower(F.substring_index(F.col("_metadata.file_path"), path.rstrip("/").split("/")[-1] + "/", -1))
    for part in skip:
        df = df.filter(~rel.contains(part))
    return df.select(
        parse_time_text(F.col("timestamp")).alias(TS),
        *[F.col(c).try_cast("double").alias(c) for c in PRICE_COLS],
        "source_file",
    )


def read_partitioned_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1 for a tree written by ``write_csv`` (``symbol=../timeframe=..`` folders)."""
    schema = T.StructType([*_RAW_OHLCV.fields, T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType())])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(
        "symbol", "timeframe", parse_time_text(F.col("timestamp")).alias(TS), *[F.col(c).try_cast("double").alias(c) for c in PRICE_COLS]
    )


def read_parquet(spark: SparkSession, paths: str | Sequence[str], merge_schema: bool = True) -> DataFrame:
    """A4: parquet files / folders; schemas of different files are merged."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def write_series_parquet(df: DataFrame, path: str, keys: Sequence[str] = KEYS, mode: str = "overwrite", ts: str = TS, file_rows: int = 1_000_000) -> None:
    """A5: one folder per series (``partitionBy``), so reads prune by key.

    Rows are first dealt out by series and time range and sorted by time, so a
    series' folder has about one file per ``file_rows`` bars (not one per task that held
    some), each over a range of time.  A range is ``file_rows`` times the bar length; rows of
    unknown timeframe are ranged by row hash and split by size only.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    step = tf_seconds("timeframe") if "timeframe" in df.columns else F.lit(None).cast("long")
    spread = F.floor(epoch_us(df, ts) / (step * F.lit(1_000_000 * file_rows)))
    placed = df.withColumn("_range", F.coalesce(spread.cast("long"), F.pmod(F.xxhash64(ts), F.lit(16))))
    out = placed.repartition(*keys, "_range").sortWithinPartitions(*keys, ts).drop("_range")
    out.write.option("maxRecordsPerFile", file_rows).mode(mode).partitionBy(*keys).parquet(path)


def write_csv(df: DataFrame, path: str, keys: Sequence[str] | None = KEYS, mode: str = "overwrite", time_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """CSV with a header per file, times as text, partitioned by series."""
    out = df.select(*[F.date_format(c, time_format).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])
    w = out.write.mode(mode).option("header", True)
    if keys:
        w = w.partitionBy(*keys)
    w.csv(path)


def append_log(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append-only log; each append adds files (each with its header)."""
    w = df.write.mode("append")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("horizon", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("pred", T.LongType()),
        T.StructField("prob", T.DoubleType()),
    ]
)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines prediction log (horizon, timestamp, pred, prob)."""
    df = spark.read.schema(PREDICTION_SCHEMA).json(path)
    return df.withColumn("timestamp", parse_time_text(F.regexp_replace("timestamp", "T", " ")))


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """A8 writer: timestamps as ISO text."""
    df.select("horizon", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "pred", "prob").write.mode(mode).json(path)


KLINE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in KLINE_FIELDS])


def normalise_klines(df: DataFrame, symbol: Column | str | None = None, timeframe: str | None = None) -> DataFrame:
    """Wide exchange klines (12 fields, epoch-ms open time, numbers as
    text) to canonical OHLCV bars.  Unparseable numbers become null."""
    ts_ms = F.col("timestamp").try_cast("long")
    cols = [from_epoch_us(ts_ms * F.lit(1000)).alias(TS)] + [F.col(c).try_cast("double").alias(c) for c in PRICE_COLS]
    keys = []
    if symbol is not None:
        keys.append((F.col(symbol) if isinstance(symbol, str) else symbol).alias("symbol"))
    if timeframe is not None:
        keys.append(F.lit(timeframe).alias("timeframe"))
    return df.select(*keys, *cols)


FILL_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("price", "qty", "commission", "commissionAsset", "tradeId")]
)
INFO_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "symbol", "orderId", "clientOrderId", "transactTime", "price", "origQty", "executedQty",
        "cummulativeQuoteQty", "status", "timeInForce", "type", "side", "workingTime",
    )]
    + [T.StructField("fills", T.ArrayType(FILL_SCHEMA))]
)
TRADE_SCHEMA = T.StructType(
    [
        T.StructField("amount", T.DoubleType()),
        T.StructField("remaining", T.DoubleType()),
        T.StructField("side", T.StringType()),
        T.StructField("filled", T.DoubleType()),
        T.StructField("info", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("datetime", T.StringType()),
    ]
)


def read_trade_fills(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A10: trade log CSV whose ``info`` column is quoted JSON; one row per fill.

    CSV options: header, ``"`` quote and escape (JSON quotes are doubled).
    ``multi_line`` allows line breaks inside values, at the price of one task
    a file.
    """
    raw = spark.read.schema(TRADE_SCHEMA).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path)
    info = raw.withColumn("info", F.from_json("info", INFO_SCHEMA))
    fills = info.select("symbol", "id", "side", F.explode("info.fills").alias("f"))
    return fills.select(
        "symbol",
        F.col("id").alias("order_id"),
        "side",
        F.col("f.tradeId").alias("trade_id"),
        F.col("f.price").try_cast("decimal(18,8)").alias("price"),
        F.col("f.qty").try_cast("decimal(18,8)").alias("qty"),
        F.col("f.commission").try_cast("decimal(18,8)").alias("commission"),
        F.col("f.commissionAsset").alias("commission_asset"),
    )


def fill_totals(fills: DataFrame) -> DataFrame:
    """A10 aggregate: per symbol quantity, notional and commission (exact decimals)."""
    return fills.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_fills"),
        F.sum("qty").cast("double").alias("qty"),
        F.sum(F.col("qty") * F.col("price")).cast("decimal(38,8)").cast("double").alias("notional"),
        F.sum("commission").cast("double").alias("commission"),
    )


def read_signal_log(spark: SparkSession, path: str) -> DataFrame:
    """Signal CSV mixing the 6-field layout (utc_ts, local_ts, pair,
    timeframe, signal, confidence) with older 4-field rows (utc_ts, pair,
    signal, confidence).  Read as text, split, branch on the field count;
    rows with any other count are kept aside with ``bad = true``."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("utc_ts"))
    p = F.split("value", ",", -1)
    n = F.size(p)
    six, four = n == 6, n == 4
    return lines.select(
        parse_time_text(F.element_at(p, 1)).alias("utc_ts"),
        F.when(six, parse_time_text(F.element_at(p, 2))).alias("local_ts"),
        F.when(six, F.element_at(p, 3)).when(four, F.element_at(p, 2)).alias("pair"),
        F.when(six, F.element_at(p, 4)).alias("timeframe"),
        F.nullif(F.when(six, F.element_at(p, 5)).when(four, F.element_at(p, 3)), F.lit("")).alias("signal"),
        F.when(six, F.element_at(p, 6)).when(four, F.element_at(p, 4)).try_cast("double").alias("confidence"),
        (~(six | four)).alias("bad"),
    )


SIGNAL_LINE = r"^(\S+ \S+),(\d+) - INFO - (SINYAL|NoSignal) -> (\S+)(?: (\S+))? confidence=([0-9.]+)"


def format_signal_line(ts: Column, pair: Column, action: Column, confidence: Column) -> Column:
    """A12 writer: ``<time>,<ms> - INFO - SINYAL -> <pair> <action> confidence=<x>``
    or ``... - NoSignal -> <pair> confidence=<x>``."""
    t = F.date_format(ts, "yyyy-MM-dd HH:mm:ss,SSS")
    conf = F.format_number(confidence, 2)
    return F.when(
        action == "NoSignal", F.format_string("%s - INFO - NoSignal -> %s confidence=%s", t, pair, conf)
    ).otherwise(F.format_string("%s - INFO - SINYAL -> %s %s confidence=%s", t, pair, action, conf))


def parse_signal_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """A12 reader: signal lines to (time, pair, action, confidence); other
    lines are ignored."""
    c = F.col(col)
    d = lines.filter(c.rlike(SIGNAL_LINE))
    g = lambda i: F.regexp_extract(c, SIGNAL_LINE, i)
    return d.select(
        F.to_timestamp_ntz(F.concat(g(1), F.lit("."), g(2))).alias("log_time"),
        g(4).alias("pair"),
        F.when(g(3) == "NoSignal", F.lit("NoSignal")).otherwise(g(5)).alias("action"),
        g(6).cast("double").alias("confidence"),
    )


def incremental_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Rows of ``incoming`` newer than the last stored time of their
    series (series not stored yet come in whole).

    The high-water mark is a one-row-per-series aggregate of ``existing``
    joined on the series key (AQE broadcasts it when measured small).
    """
    keys = list(keys)
    mark = existing.groupBy(*keys).agg(F.max(ts).alias("_hw"))
    d = incoming.join(mark, keys, "left")
    return d.filter(F.col("_hw").isNull() | (F.col(ts) > F.col("_hw"))).drop("_hw")
