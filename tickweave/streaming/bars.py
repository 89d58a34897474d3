"""Streaming feed, bars, de-duplication and rule signals.

The reference polled an exchange in a sleep loop and recomputed everything on
the last 500-600 bars.  Here the feed is a Structured Streaming file source;
bars are an event-time windowed aggregate with a watermark, or partial bars
that late ticks still correct; the EMA / RSI rule carries its averages from
micro-batch to micro-batch in a state table (no 600-bar cut-off).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.core import from_epoch_us, to_utc_timestamp_col
from tickweave.operators.ewm import Ema, ewm
from tickweave.operators.indicators import gain_loss, lag, rsi_ema_expr, windowed
from tickweave.operators.signals import rule_expr
from tickweave.schema import KEYS, TIMEFRAMES, TS
from tickweave.streaming.epochs import EpochTable

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def file_feed(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """New files under ``path`` as a stream (run with ``trigger(availableNow=True)``
    in tests, ``processingTime`` live).  ``glob`` picks files by name."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def with_event_time(df: DataFrame, ts: str = "ts", out: str = "event_time") -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``): the UTC wall
    clock is turned into an instant without the session zone."""
    return df.withColumn(out, to_utc_timestamp_col(F.col(ts)))


def stream_bars(ticks: DataFrame, timeframe: str = "1h", watermark: str = "10 minutes", symbol: str = "symbol",
                price: str = "price", event_time: str = "event_time", volume: str | None = None) -> DataFrame:
    """Ticks to OHLCV bars per symbol, tumbling event-time windows.

    Append mode emits a bar once the watermark passes its end; later ticks
    for it are dropped, so emitted bars equal the batch bars of closed windows.
    ``CorrectedBars`` takes late ticks in.
    """
    secs = TIMEFRAMES[timeframe]
    vol = F.sum(volume).cast("double") if volume else F.count(F.lit(1)).cast("double")
    agg = (
        ticks.withWatermark(event_time, watermark)
        .groupBy(F.window(event_time, f"{secs} seconds").alias("w"), F.col(symbol).alias("symbol"))
        .agg(
            F.min_by(price, event_time).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, event_time).alias("close"),
            vol.alias("volume"),
        )
    )
    return agg.select(
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        from_epoch_us(F.unix_micros(F.col("w.start"))).alias(TS),
        "open", "high", "low", "close", "volume",
    )


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str = "event_time", watermark: str = "10 minutes") -> DataFrame:
    """Drop re-delivered rows (overlapping fetches) within the watermark;
    state for a key is dropped once the watermark passes it."""
    return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))


PART_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField(TS, T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")],
        T.StructField("first_tick", T.TimestampType()),
        T.StructField("last_tick", T.TimestampType()),
        T.StructField("ticks", T.LongType()),
    ]
)


def _merged(parts: DataFrame) -> DataFrame:
    """One row per bar from partial bars of disjoint ticks."""
    return parts.groupBy("symbol", "timeframe", TS).agg(
        F.min_by("open", F.struct("first_tick", "open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.struct("last_tick", "close")).alias("close"),
        F.sum("volume").alias("volume"),
        F.min("first_tick").alias("first_tick"),
        F.max("last_tick").alias("last_tick"),
        F.sum("ticks").alias("ticks"),
        F.count(F.lit(1)).alias("parts"),
    )


class CorrectedBars:
    """S2 with corrections: bars that late ticks still change, however late they come.

    Every micro-batch writes the partial bars of its own ticks (an aggregate with a
    map-side combine; no state is kept and no tick is dropped); ``bars`` merges the
    parts by window, so a tick for a closed bar corrects it at the next read.
    ``compact`` merges the parts of the finished epochs into one, which bounds what a
    read has to merge.  Ticks of equal time take the smaller price as the earlier one.
    """

    def __init__(self, spark: SparkSession, path: str, timeframe: str = "1h"):
        self.timeframe = timeframe
        self.parts, self.base = (EpochTable(spark, f"{path}/{n}", PART_SCHEMA) for n in ("parts", "base"))

    def _merged_until(self) -> int:
        return max(self.base.epochs(), default=-1)

    def process(self, ticks: DataFrame, epoch: int) -> None:
        """One micro-batch of ``symbol, event_time, price[, volume]``; also for ``foreachBatch``."""
        if epoch <= self._merged_until():
            return  # tried again after a compaction that holds it
        volume = F.coalesce(F.col("volume").cast("double"), F.lit(0.0)) if "volume" in ticks.columns else F.lit(1.0)
        w = F.window("event_time", f"{TIMEFRAMES[self.timeframe]} seconds")
        start = from_epoch_us(F.unix_micros(w["start"]))
        one = ticks.where("price is not null and event_time is not null").select(
            "symbol", F.lit(self.timeframe).alias("timeframe"), start.alias(TS), *[F.col("price").alias(c) for c in ("open", "high", "low", "close")],
            volume.alias("volume"), F.col("event_time").alias("first_tick"), F.col("event_time").alias("last_tick"), F.lit(1).cast("long").alias("ticks"),
        )
        self.parts.write(_merged(one), epoch)

    def start(self, ticks: DataFrame, checkpoint: str, **trigger):
        """Runs the stream; ``trigger`` as for ``DataStreamWriter.trigger``."""
        return ticks.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def bars(self) -> DataFrame:
        """All bars as corrected so far, with ``ticks`` and ``parts`` (micro-batches that added to
        the bar since the last compaction; above 1: corrected or continued)."""
        return self._all().drop("first_tick", "last_tick")

    def _all(self) -> DataFrame:
        until = self._merged_until()
        return _merged(self.base.before(until + 1).unionByName(self.parts.read(after=until)))

    def compact(self) -> None:
        """Merges the parts of all finished epochs into one base table of the newest; from
        its last file on, readers take the base and later parts.  Then the merged parts go."""
        done = self.parts.epochs()
        if done:
            self.base.write(self._all(), done[-1])
            self.parts.forget(done[-1] + 1)
            self.base.forget(done[-1])


SIGNAL_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField(TS, T.TimestampNTZType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("signal", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in ("ema12", "ema26", "au", "ad")],
        *[T.StructField(c, T.LongType()) for c in ("row", "close_at", "diff_at")],  # its number in the batch, if it holds a close (a difference)
    ]
)
STATE = [TS, "close", "ema12", "ema26", "au", "ad"]
GAPS = ["close_gap", "diff_gap"]  # rows since the last close (difference)
STATE_SCHEMA = T.StructType([f for f in SIGNAL_SCHEMA.fields if f.name in (*KEYS, *STATE)] + [T.StructField(c, T.LongType()) for c in GAPS])
LATE_SCHEMA = T.StructType([f for f in SIGNAL_SCHEMA.fields if f.name in (*KEYS, TS, "close")])


class RuleStream:
    """S3: the E1 rule on every new bar, with the averages carried from batch to batch.

    ``root`` holds three tables, one folder per micro-batch: ``signals`` (a row per new bar),
    ``state`` (a row per series: last time and close, EMA12, EMA26, the two RSI
    averages, rows since their last values) and ``late`` (bars that are not newer than the series' last one).  A
    micro-batch puts each series' state before its new bars as a row that seeds the
    averages, and runs the batch plan of ``ema_rsi_backtest`` over them: segments of rows,
    so the backlog of one series is spread over tasks, whatever its size.  Of bars of
    equal time in a batch the one with the smallest close counts, the others are late.  A
    null close keeps the averages.  A micro-batch that is tried again writes the same
    folders again.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = KEYS):
        self.keys = list(keys)
        self.signals, self.state, self.late = (EpochTable(spark, f"{root}/{n}", s) for n, s in (("signals", SIGNAL_SCHEMA), ("state", STATE_SCHEMA), ("late", LATE_SCHEMA)))

    def process(self, bars: DataFrame, epoch: int) -> None:
        """One micro-batch of ``keys, timestamp, close``; also for ``foreachBatch``."""
        keys = self.keys
        state = self.state.before(epoch)
        seen = state.select(*keys, F.col(TS).alias("_seen"))
        found = bars.select(*keys, TS, "close").join(seen, keys, "left")
        first = F.row_number().over(Window.partitionBy(*keys, TS).orderBy(F.asc_nulls_last("close")))
        found = found.withColumn("_late", F.coalesce(F.col(TS) <= F.col("_seen"), F.lit(False)) | (first > 1))
        self.late.write(found.where("_late"), epoch)
        new = {"ema12": "double", "ema26": "double", "au": "double", "ad": "double", "close_gap": "long", "diff_gap": "long"}
        fresh = found.where("not _late").select(*keys, TS, "close", *[F.lit(None).cast(t).alias(c) for c, t in new.items()], F.lit(False).alias("_seed"))
        seeds = state.join(fresh.select(*keys).distinct(), keys, "left_semi").select(*keys, *STATE, *GAPS, F.lit(True).alias("_seed"))
        rows = self._averaged(seeds.unionByName(fresh)).where("not _seed")
        signal, confidence = rule_expr(F.col("ema12"), F.col("ema26"), rsi_ema_expr(F.col("au"), F.col("ad")))
        done = self.signals.write(rows.select("*", signal.alias("signal"), confidence.alias("confidence")), epoch)
        self.state.write(self._after(done, state), epoch)
        self.state.forget(epoch - 1)

    def _averaged(self, rows: DataFrame) -> DataFrame:
        """New values of the averages on every row; a seed row keeps those it brings, and counts as
        lying where its series' last value lay."""
        keys, seed, i = self.keys, F.col("_seed"), F.col("_i")
        up, down = gain_loss(F.col("close") - lag("close", 1, keys))
        inputs = {"ema12": F.col("close"), "ema26": F.col("close"), "au": up, "ad": down}
        d = windowed(rows, [[(f"_in_{c}", F.when(seed, F.col(c)).otherwise(x)) for c, x in inputs.items()]], back=1, keys=keys)
        spans = {"ema12": (12, "close_gap"), "ema26": (26, "close_gap"), "au": (14, "diff_gap"), "ad": (14, "diff_gap")}
        emas = [Ema(c, f"_in_{c}", 2.0 / (n + 1.0), gaps=True, place=i - F.when(seed, F.col(gap)).otherwise(F.lit(0))) for c, (n, gap) in spans.items()]
        d = ewm(d.drop(*spans), emas, keys, partitioned=True)
        return d.select("*", i.alias("row"), F.when(F.col("close").isNotNull(), i).alias("close_at"), F.when(F.col("_in_au").isNotNull(), i).alias("diff_at"))

    def _after(self, done: DataFrame, state: DataFrame) -> DataFrame:
        """The state behind the rows of a micro-batch: a row per series, old or new."""
        keys = self.keys
        last = done.groupBy(*keys).agg(F.max_by(F.struct(*STATE), TS).alias("_last"), *[F.max(c).alias(f"_{c}") for c in ("row", "close_at", "diff_at")])
        joined = state.join(last, keys, "full_outer")
        pick = [F.when(F.col("_row").isNull(), F.col(c)).otherwise(F.col("_last")[c]).alias(c) for c in STATE]
        # a seed row has the number 0
        gaps = [F.when(F.col("_row").isNull(), F.col(g)).otherwise(F.coalesce(F.col("_row") - F.col(f"_{g[:-4]}_at"), F.col("_row") + F.col(g), F.lit(0))).alias(g) for g in GAPS]
        return joined.select(*keys, *pick, *gaps)

    def start(self, bars: DataFrame, checkpoint: str, **trigger):
        """Runs the stream; ``trigger`` as for ``DataStreamWriter.trigger``."""
        return bars.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
