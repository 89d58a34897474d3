"""Registered queries for cleaning and table-shape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions.core import epoch_us, rounded
from tickweave.operators import clean
from tickweave.operators.bars import dedup_keep_first, regularise, ticks_to_bars
from tickweave.operators import indicators as ind
from tickweave.operators.ewm import Ema, ewm_gaps
from tickweave.operators.indicators import fill_chain
from tickweave.operators.series import IDX, SEG
from tickweave.operators.signals import ema_rsi_backtest
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import _BACKTEST_SQL, KEYS_SQL, out, query, with_bars
from tickweave.plans.inputs import bars_cte, event_bars, table
from tickweave.schema import KEYS, PRICE_COLS, TS

VALS = list(PRICE_COLS)
ROUND_VALS = ", ".join(q.r(c, c) for c in VALS)

_GRID_SQL = """span AS (SELECT symbol, timeframe, min(timestamp) AS t0, max(timestamp) AS t1 FROM bars GROUP BY 1, 2),
grid AS (SELECT symbol, timeframe, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS timestamp FROM span),
reg AS (SELECT g.symbol, g.timeframe, g.timestamp, b.open, b.high, b.low, b.close, b.volume
        FROM grid g LEFT JOIN bars b USING (symbol, timeframe, timestamp))"""


def reg_bars(spark, sf):
    return regularise(event_bars(spark, sf, "1h"))


@query("b5_regularise", with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, {ROUND_VALS} FROM reg"))
def b5_regularise(spark, sf):
    return out(reg_bars(spark, sf), VALS)


def _ffill_sql(c):
    return f"last_value({c} IGNORE NULLS) OVER ({q.ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _bfill_sql(c):
    return f"first_value({c} IGNORE NULLS) OVER ({q.ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


_GAPS = f"""{_GRID_SQL},
e AS (SELECT *, {q.ema_gaps('close', 2 / 13)} AS ema12, {q.ema_gaps('close', 2 / 27)} AS ema26, {q.ema_gaps('close', 0.4)} AS ema_a,
  close - {q.lag('close')} AS delta FROM reg),
s AS (SELECT *, ema12 - ema26 AS macd, {q.ema_gaps('greatest(delta, 0)', 1 / 14).replace('greatest(delta, 0)', 'CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END')} AS au,
  {q.ema_gaps('ABC', 1 / 14).replace('ABC', 'CASE WHEN delta IS NOT NULL THEN -least(delta, 0) END')} AS ad FROM e),
m AS (SELECT *, {q.ema_gaps('macd', 0.2)} AS macd_signal FROM s)"""


@query("c9_ema_gaps", with_bars(f"{_GAPS}\nSELECT {KEYS_SQL}, {q.r('ema12', 'ema12')}, {q.r('ema_a', 'ema_a')} FROM m"))
def c9_ema_gaps(spark, sf):
    """EMAs on the unfilled grid (missing closes), two spans in one pass."""
    return out(ewm_gaps(reg_bars(spark, sf), [Ema.span("ema12", "close", 12), Ema("ema_a", "close", 0.4)]), ["ema12", "ema_a"])


@query("c11_macd_gaps", with_bars(f"{_GAPS}\nSELECT {KEYS_SQL}, {q.r('macd', 'macd')}, {q.r('macd_signal', 'macd_signal')} FROM m"))
def c11_macd_gaps(spark, sf):
    return out(ind.macd(reg_bars(spark, sf), gaps=True), ["macd", "macd_signal"])


@query("c12_rsi_gaps", with_bars(f"""{_GAPS}
SELECT {KEYS_SQL}, {q.r("coalesce(100.0 - 100.0 / (1.0 + au / NULLIF(ad, 0)), 50.0)", "rsi14")} FROM m"""))
def c12_rsi_gaps(spark, sf):
    return out(ind.rsi_wilder(reg_bars(spark, sf), gaps=True), ["rsi14"])


@query("b6_ffill", with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(_ffill_sql(c), c) for c in VALS) + " FROM reg"))
def b6_ffill(spark, sf):
    return out(clean.ffill(reg_bars(spark, sf), VALS), VALS)


@query("b7_bfill", with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(_bfill_sql(c), c) for c in VALS) + " FROM reg"))
def b7_bfill(spark, sf):
    return out(clean.bfill(reg_bars(spark, sf), VALS), VALS)


@query("b8_fill_const", with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(f"coalesce({c}, 0.0)", c) for c in VALS) + " FROM reg"))
def b8_fill_const(spark, sf):
    return out(clean.fill_const(reg_bars(spark, sf), 0.0, VALS), VALS)


@query(
    "b9_fill_chain",
    with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(f"coalesce({_ffill_sql(c)}, {_bfill_sql(c)}, 0.0)", c) for c in VALS) + " FROM reg"),
)
def b9_fill_chain(spark, sf):
    """The reference's gap handling: ``asfreq().ffill().bfill()`` (+0), the
    fill fused into the grid pass."""
    d = regularise(event_bars(spark, sf, "1h"), fill="ffill_bfill").na.fill(0.0, subset=VALS)
    return out(d, VALS)


@query("b10_dropna", with_bars(f"{_GRID_SQL}\nSELECT {KEYS_SQL}, {ROUND_VALS} FROM reg WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL"))
def b10_dropna(spark, sf):
    return out(clean.drop_nulls(reg_bars(spark, sf).drop(IDX)), VALS)


@query(
    "b4_dedup_keep_first",
    with_bars(
        f"""u AS (SELECT *, 0 AS src FROM bars
       UNION ALL SELECT symbol, timeframe, timestamp + INTERVAL 1 HOUR, open, high, low, close + 1.0, volume, 1 FROM bars),
k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY symbol, timeframe, timestamp ORDER BY src) = 1)
SELECT {KEYS_SQL}, src, {ROUND_VALS} FROM k"""
    ),
)
def b4_dedup_keep_first(spark, sf):
    """Bars plus a copy one hour later with a shifted close (a second, later
    source); keep-first must keep the original row wherever both exist."""
    b = event_bars(spark, sf, "1h")
    later = b.select(*KEYS, (F.col(TS) + F.expr("INTERVAL 1 HOUR")).alias(TS), "open", "high", "low", (F.col("close") + 1.0).alias("close"), "volume")
    u = clean.union_all([b.withColumn("src", F.lit(0)), later.withColumn("src", F.lit(1))])
    return out(dedup_keep_first(u, ["src"]), VALS, ["src"])


@query(
    "b11_coerce_numeric",
    """SELECT event_id,
  round(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0), 6) + 0.0 AS k_num,
  round(coalesce(TRY_CAST(event_type AS DOUBLE), 0.0), 6) + 0.0 AS type_num,
  round(coalesce(TRY_CAST(value AS DOUBLE), 0.0), 6) + 0.0 AS value
FROM events""",
)
def b11_coerce_numeric(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k_num"), F.col("event_type").alias("type_num"), "value")
    d = clean.coerce_numeric(ev, ["k_num", "type_num", "value"])
    return d.select("event_id", *[rounded(c).alias(c) for c in ("k_num", "type_num", "value")])


@query("b12_numeric_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) + 0.0 AS l_quantity, round(l_extendedprice, 6) + 0.0 AS l_extendedprice, round(l_discount, 6) + 0.0 AS l_discount, round(l_tax, 6) + 0.0 AS l_tax FROM lineitem")
def b12_numeric_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = clean.numeric_columns(li)
    return li.select(*[rounded(c).alias(c) if dict(li.dtypes)[c] == "double" else F.col(c) for c in cols])


@query("b13_drop_if_present", with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, {q.r('open', 'open')}, {q.r('high', 'high')}, {q.r('low', 'low')}, {q.r('close', 'close')} FROM o"))
def b13_drop_if_present(spark, sf):
    return out(clean.drop_if_present(event_bars(spark, sf), "volume", "target", "no_such_column"), ["open", "high", "low", "close"])


_USER_BARS = """ub AS (SELECT CAST(user_id AS VARCHAR) AS symbol, '1h' AS timeframe, date_trunc('hour', ts) AS timestamp,
   arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2, 3)"""


@query(
    "b14_min_history",
    f"""WITH {_USER_BARS},
n AS (SELECT symbol, timeframe FROM ub GROUP BY 1, 2 HAVING count(*) >= 50)
SELECT {KEYS_SQL}, round(close, 6) + 0.0 AS close, round(volume, 6) + 0.0 AS volume FROM ub SEMI JOIN n USING (symbol, timeframe)""",
)
def b14_min_history(spark, sf):
    """Per-user hourly bars; series with fewer than 50 bars are skipped."""
    ev = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("symbol"), "ts", "value")
    ub = ticks_to_bars(ev, "1h", price="value")
    return out(clean.min_history(ub, 50), ["close", "volume"])


_ALIGN = ["close", "volume", "rsi14", "open", "return1"]


@query(
    "b15_align_features",
    with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, {q.r('close', 'close')}, {q.r('volume', 'volume')}, 0.0 AS rsi14, {q.r('open', 'open')}, 0.0 AS return1 FROM o"),
)
def b15_align_features(spark, sf):
    """Align bars to a model feature list with missing (rsi14, return1) and
    extra (high, low) columns; applying it twice changes nothing."""
    d = clean.align_features(event_bars(spark, sf), _ALIGN, keep=[*KEYS, TS])
    d = clean.align_features(d, _ALIGN, keep=[*KEYS, TS])
    return out(d, _ALIGN)


@query("b16_threshold_filter", with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt WHERE confidence >= 0.3"))
def b16_threshold_filter(spark, sf):
    return out(clean.threshold_filter(ema_rsi_backtest(event_bars(spark, sf)), "confidence", 0.3), ["confidence"], ["signal"])


@query("b17_rename_timestamp", "SELECT event_id, ts AS timestamp FROM events")
def b17_rename_timestamp(spark, sf):
    return clean.rename_to_timestamp(table(spark, sf, "events").select("event_id", "ts"), "ts")


@query(
    "b18_union_frames",
    f"""WITH {bars_cte('1h', 'b1')}, {bars_cte('15m', 'b2')},
u AS (SELECT *, NULL AS n_hour FROM b1 UNION ALL SELECT *, CAST(hour(timestamp) AS INTEGER) AS n_hour FROM b2)
SELECT {KEYS_SQL}, n_hour, {ROUND_VALS} FROM u""",
)
def b18_union_frames(spark, sf):
    b1 = event_bars(spark, sf, "1h")
    b2 = event_bars(spark, sf, "15m").withColumn("n_hour", F.hour(TS))
    return out(clean.union_all([b1, b2]), VALS, ["n_hour"])


@query(
    "b1_canonical",
    with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, {ROUND_VALS} FROM o"),
)
def b1_canonical(spark, sf):
    b = event_bars(spark, sf).withColumn("extra", F.lit(1))
    return out(clean.canonical(clean.require_columns(b, PRICE_COLS)), VALS)


@query(
    "b2_required_columns",
    with_bars("""o AS (SELECT * FROM bars)
SELECT 'all' AS frame, count(*) AS n, '' AS missing FROM o
UNION ALL SELECT 'no volume', NULL, 'volume' UNION ALL SELECT 'times only', NULL, 'open,high,low,close,volume'"""),
)
def b2_required_columns(spark, sf):
    """Frames with all, all but one and none of the price columns: rows, or the columns the refusal names."""
    b = event_bars(spark, sf)
    frames = []
    for name, df in (("all", b), ("no volume", b.drop("volume")), ("times only", b.select(*KEYS, TS))):
        try:
            frames.append(clean.require_columns(df, PRICE_COLS).agg(F.count("*").alias("n")).select(F.lit(name).alias("frame"), "n", F.lit("").alias("missing")))
        except ValueError as e:
            named = ",".join(c for c in PRICE_COLS if f"'{c}'" in str(e))
            frames.append(b.limit(1).select(F.lit(name).alias("frame"), F.lit(None).cast("long").alias("n"), F.lit(named).alias("missing")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "b3_parse_utc",
    """SELECT event_id, ts AS timestamp,
  make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_ms,
  CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S') || '+02:00', '%Y-%m-%d %H:%M:%S%z') AT TIME ZONE 'UTC' AS TIMESTAMP) AS from_offset
FROM events""",
)
def b3_parse_utc(spark, sf):
    """Epoch-ms numbers and offset-suffixed text to UTC wall-clock time."""
    ev = table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.floor(epoch_us(table(spark, sf, "events"), "ts") / 1000).alias("from_ms"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")).alias("from_offset"),
    )
    d = clean.to_utc(ev, "from_ms", epoch_ms=True)
    return clean.to_utc(d, "from_offset", fmt="yyyy-MM-dd HH:mm:ssXXX")


@query(
    "a3_series_key_from_name",
    """WITH n AS (SELECT event_type || '__1h__' || strftime(date_trunc('second', ts), '%Y%m%d_%H%M%S')
     || CASE WHEN event_id % 7 = 0 THEN '' ELSE '__chunk' || CAST(event_id % 7 AS VARCHAR) END || '.csv' AS file_name FROM events)
SELECT file_name, split_part(file_name, '__', 1) AS pair, split_part(file_name, '__', 2) AS timeframe,
  strptime(split_part(replace(file_name, '.csv', ''), '__', 3), '%Y%m%d_%H%M%S') AS run_time,
  TRY_CAST(NULLIF(regexp_extract(file_name, '__chunk(\\d+)', 1), '') AS INTEGER) AS chunk FROM n""",
)
def a3_series_key_from_name(spark, sf):
    """Write a file name per event in the reference's naming scheme (chunk
    number from the event id), then parse pair, timeframe, run time and chunk
    back from it."""
    ev = table(spark, sf, "events")
    chunk = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 7).cast("int"))
    names = ev.select(clean.series_file_name(F.col("event_type"), F.lit("1h"), F.col("ts"), chunk).alias("file_name"))
    parts = clean.parse_series_name(F.col("file_name"))
    return names.select("file_name", *[v.alias(k) for k, v in parts.items()])


@query(
    "a13_manifest",
    f"""WITH {bars_cte('1h', 'b1')}, {bars_cte('15m', 'b2')},
u AS (SELECT symbol || '__' || timeframe AS source, timestamp FROM b1 UNION ALL SELECT symbol || '__' || timeframe, timestamp FROM b2)
SELECT source, count(*) AS rows, min(timestamp) AS first_ts FROM u GROUP BY source""",
)
def a13_manifest(spark, sf):
    u = clean.union_all([event_bars(spark, sf, "1h"), event_bars(spark, sf, "15m")])
    u = u.select(F.concat_ws("__", "symbol", "timeframe").alias("source"), TS)
    return clean.manifest(u, "source")


@query(
    "a16_coverage",
    f"""WITH {bars_cte('1h', 'b1')}, {bars_cte('15m', 'b2')},
p AS (SELECT symbol, timeframe FROM b1 UNION ALL SELECT symbol, timeframe FROM b2),
e AS (SELECT DISTINCT symbol, unnest(['1m', '5m', '15m', '1h']) AS timeframe FROM p)
SELECT symbol, timeframe FROM e ANTI JOIN (SELECT DISTINCT symbol, timeframe FROM p) USING (symbol, timeframe)""",
)
def a16_coverage(spark, sf):
    present = clean.union_all([event_bars(spark, sf, "1h"), event_bars(spark, sf, "15m")])
    return clean.coverage(present, ["1m", "5m", "15m", "1h"])
