"""Registered streaming queries.

Each query runs a Structured Streaming job over the driver tables with
``trigger(availableNow=True)`` into a file sink (a fresh folder under the
checkpoint directory per run, with its own stream checkpoint), waits for it,
and returns the sink read back as a batch DataFrame.  Closed-window outputs
have oracles (they equal the batch results on bars whose window closed
before the final watermark); model outputs are rows-only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.core import epoch_us, rounded
from tickweave.operators import labels as lab
from tickweave.operators import ml
from tickweave.operators.indicators import indicators
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import KEYS_SQL, backtest_sql, query
from tickweave.plans.catalog_sources import scratch
from tickweave.plans.inputs import bars_cte, event_bars, table
from tickweave.session import ensure_checkpoint_dir
from tickweave.schema import BARS_SCHEMA, INDICATOR_COLS, KEYS, PRICE_COLS, TS
from tickweave.streaming import bars as sb
from tickweave.streaming.learn import OnlineLogisticBag, stream_score

WATERMARK = "10 minutes"

# Bars whose hour closed before the final watermark (max event time - 10 min).
_CLOSED_BARS = f"""WITH {bars_cte('1h', 'allbars')},
bars AS (SELECT * FROM allbars WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE)"""


def _run_dir(spark, name: str) -> str:
    return scratch(spark, f"{name}/{uuid.uuid4().hex}")


def _drain(stream: DataFrame, path: str, mode: str = "append") -> None:
    q_ = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", path + "/out").option("checkpointLocation", path + "/_ckpt")
        .trigger(availableNow=True).start()
    )
    q_.awaitTermination()


def _event_feed(spark, sf):
    return sb.with_event_time(sb.file_feed(spark, sf, sb.EVENT_SCHEMA, glob="events.parquet", files_per_batch=1))


def _stream_bars_to(spark, sf, path):
    ticks = _event_feed(spark, sf).select(F.col("event_type").alias("symbol"), F.col("value").alias("price"), "event_time")
    _drain(sb.stream_bars(ticks, "1h", WATERMARK), path)
    return spark.read.schema(BARS_SCHEMA).parquet(path + "/out")


@query("s1_stream_feed", "SELECT event_id, ts, event_type, round(value, 6) + 0.0 AS value FROM events")
def s1_stream_feed(spark, sf):
    """The events table read as a file stream and landed unchanged."""
    path = _run_dir(spark, "s1")
    _drain(_event_feed(spark, sf).select("event_id", "ts", "event_type", "value"), path)
    d = spark.read.parquet(path + "/out")
    return d.select("event_id", "ts", "event_type", rounded("value").alias("value"))


@query("s2_stream_bars", f"{_CLOSED_BARS}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in PRICE_COLS) + " FROM bars")
def s2_stream_bars(spark, sf):
    """Watermarked 1h bars per symbol in append mode: every closed window,
    equal to the batch bars; the still-open last hour is held back."""
    d = _stream_bars_to(spark, sf, _run_dir(spark, "s2"))
    return d.select(*KEYS, TS, *[rounded(c).alias(c) for c in PRICE_COLS])


def _land(df: DataFrame, path: str, pieces) -> None:
    """One file per condition, in this order."""
    for p in pieces:
        df.where(p).coalesce(1).write.mode("append").parquet(path)


#: Ticks that the feed delivers late: one in ten, by id; and the days on which files end.
_LATE_TICK, _CUTS = "event_id % 10 = 7", [f"2024-01-{d:02d}" for d in (1, 7, 13, 19, 25)] + ["2100-01-01"]


@query("s2_corrected_bars", f"WITH {bars_cte('1h')}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in PRICE_COLS) + " FROM bars")
def s2_corrected_bars(spark, sf):
    """Five files of ticks in order of time, one tick in ten delivered a file later or after
    all others; the corrected bars equal the batch bars of every window."""
    root = _run_dir(spark, "s2c")
    ticks = sb.with_event_time(table(spark, sf, "events")).select("event_id", "ts", F.col("event_type").alias("symbol"), F.col("value").alias("price"), "event_time")
    span = [f"ts >= '{a}' and ts < '{b}'" for a, b in zip(_CUTS, _CUTS[1:])]
    pieces = [f"{s} and not {_LATE_TICK}" for s in span]
    pieces[2] = f"({pieces[2]}) or ({span[1]} and {_LATE_TICK})"
    pieces.append(f"{_LATE_TICK} and not ({span[1]})")
    _land(ticks.withColumn("ts", F.col("ts").cast("string")), root + "/landing", pieces)
    feed = sb.file_feed(spark, root + "/landing", spark.read.parquet(root + "/landing").schema, files_per_batch=1)
    bars = sb.CorrectedBars(spark, root + "/parts", "1h")
    bars.start(feed, root + "/_ckpt").awaitTermination()
    return bars.bars().select(*KEYS, TS, *[rounded(c).alias(c) for c in PRICE_COLS])


#: Bars that come after all others, and therefore late: those of 5 o'clock.
_LATE_BARS = "date_part('hour', timestamp) = 5"


def _rule_stream(spark, sf, name: str, late: bool):
    root = _run_dir(spark, name)
    bars = event_bars(spark, sf).select(*KEYS, TS, "close").withColumn("day", F.date_format(TS, "yyyy-MM-dd")).persist()
    prompt = f"not ({_LATE_BARS})" if late else "true"
    cuts = _CUTS[::3] + _CUTS[-1:] if late else _CUTS
    _land(bars, root + "/landing", [f"day >= '{a}' and day < '{b}' and {prompt}" for a, b in zip(cuts, cuts[1:])] + ([_LATE_BARS] if late else []))
    bars.unpersist()
    feed = sb.file_feed(spark, root + "/landing", BARS_SCHEMA, files_per_batch=1)
    rule = sb.RuleStream(spark, root + "/rule")
    rule.start(feed, root + "/_ckpt").awaitTermination()
    return rule


@query("s3_stream_signals", f"WITH {bars_cte('1h')},\n{backtest_sql()}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt")
def s3_stream_signals(spark, sf):
    """Five micro-batches of bars through the EMA/RSI rule, with the averages carried
    in the state table; equals the batch backtest."""
    d = _rule_stream(spark, sf, "s3", late=False).signals.read()
    return d.select(*KEYS, TS, "signal", rounded("confidence").alias("confidence"))


_PROMPT = f"WITH {bars_cte('1h', 'allbars')}, bars AS (SELECT * FROM allbars WHERE NOT {_LATE_BARS}),\n{backtest_sql()}"


@query(
    "s3_late_bars",
    f"""{_PROMPT}
SELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt
UNION ALL SELECT symbol, timeframe, timestamp, 'late', NULL FROM allbars WHERE {_LATE_BARS}""",
)
def s3_late_bars(spark, sf):
    """Bars that come after newer ones of their series take no part in the rule and lie in the
    late table; the others equal the batch backtest without them."""
    rule = _rule_stream(spark, sf, "s3l", late=True)
    signals = rule.signals.read().select(*KEYS, TS, "signal", rounded("confidence").alias("confidence"))
    return signals.unionByName(rule.late.read().select(*KEYS, TS, F.lit("late").alias("signal"), F.lit(None).cast("double").alias("confidence")))


@query("s4_stream_score")
def s4_stream_score(spark, sf):
    """A model fitted on the batch bars scores the bar stream; rows with
    P(up) >= 0.6 or <= 0.4 go to the append-only high-confidence log."""
    root = _run_dir(spark, "s4")
    _stream_bars_to(spark, sf, root + "/bars")
    feats = list(PRICE_COLS)
    train = lab.next_bar_up(event_bars(spark, sf), out="target", last_row="drop").drop("_i")
    model = ml.gbt_model(feats, "target", maxIter=10, maxDepth=3).fit(train)
    bars = sb.file_feed(spark, root + "/bars/out", BARS_SCHEMA, files_per_batch=1)
    _drain(stream_score(model, bars, [*KEYS, TS, "close"]), root + "/log")
    d = spark.read.parquet(root + "/log/out")
    return d.select(*KEYS, TS, "pred", rounded("prob").alias("prob"), rounded("close").alias("close"))


@query("s5_stream_dedup", "SELECT event_id, ts, event_type, round(value, 6) + 0.0 AS value FROM events")
def s5_stream_dedup(spark, sf):
    """Overlapping fetches: the events land once, then the second half of
    them lands again; de-duplication within the watermark keeps one copy."""
    root = _run_dir(spark, "s5")
    ev = table(spark, sf, "events")
    ev.coalesce(1).write.mode("append").parquet(root + "/landing")
    ev.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(root + "/landing")
    feed = sb.with_event_time(sb.file_feed(spark, root + "/landing", sb.EVENT_SCHEMA, files_per_batch=1))
    _drain(sb.dedup_stream(feed, ["event_id"], watermark=WATERMARK).select("event_id", "ts", "event_type", "value"), root)
    d = spark.read.parquet(root + "/out")
    return d.select("event_id", "ts", "event_type", rounded("value").alias("value"))


@query("s6_online_learning")
def s6_online_learning(spark, sf):
    """labelled indicator rows arrive in ten time-ordered files; each
    micro-batch is scored by the bagged online logistic model, then learned."""
    root = _run_dir(spark, "s6")
    feats = [c for c in (*PRICE_COLS, *INDICATOR_COLS) if c != "spread"]
    d = indicators(event_bars(spark, sf)).drop("_i")
    d = lab.next_bar_up(d, out="target", last_row="drop").drop("_i")
    ensure_checkpoint_dir(spark)
    d = d.checkpoint(eager=True)  # reliable checkpoint: the ten landings reuse it
    t0, t1 = d.agg(F.min(epoch_us(d, TS)), F.max(epoch_us(d, TS))).first()
    part = F.floor((epoch_us(d, TS) - F.lit(t0)) * F.lit(10) / F.lit((t1 or 0) - (t0 or 0) + 1))
    d.withColumn("_part", part.cast("int")).write.partitionBy("_part").parquet(root + "/staged")  # so that a landing reads its own rows only
    staged = spark.read.schema(T.StructType([*d.schema, T.StructField("_part", T.IntegerType())])).parquet(root + "/staged")
    for k in range(10):  # ten landings, equal ranges of the whole time span (fixture writes, not the operator)
        staged.where(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(root + "/landing")
    feed = sb.file_feed(spark, root + "/landing", d.schema, files_per_batch=1)
    learner = OnlineLogisticBag(spark, feats, "target", [*KEYS, TS], root + "/predictions", root + "/state")
    q_ = feed.writeStream.foreachBatch(learner.process).option("checkpointLocation", root + "/_ckpt").trigger(availableNow=True).start()
    q_.awaitTermination()
    out = spark.read.parquet(root + "/predictions")
    return out.select(*KEYS, TS, "y", "pred", rounded("prob").alias("prob"), "epoch")
