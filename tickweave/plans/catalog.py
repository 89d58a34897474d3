"""Registered queries: one per operator, each with its DuckDB oracle text.

Every query reads the driver tables (mostly through ``event_bars``), runs over
whole tables, rounds doubles to 6 places (both sides) and names every column
the same as its oracle.  Queries without an exact SQL form (models, streams,
random splits) register no oracle and get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.core import rounded
from tickweave.operators import indicators as ind
from tickweave.operators.bars import latest_per_series
from tickweave.operators.ewm import Ema, ewm
from tickweave.operators.series import ensure_index
from tickweave.operators.signals import ema_rsi_backtest, latest_signal
from tickweave.plans import sqlbits as q
from tickweave.plans.inputs import bars_cte, event_bars
from tickweave.schema import INDICATOR_COLS, KEYS, PRICE_COLS, TS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def out(df: DataFrame, doubles, others=()) -> DataFrame:
    """Keys, timestamp, ``others`` as they are, ``doubles`` rounded."""
    return df.select(*KEYS, TS, *others, *[rounded(c).alias(c) for c in doubles])


def with_bars(sql: str, timeframe: str = "1h") -> str:
    return f"WITH {bars_cte(timeframe)},\n{sql}"


KEYS_SQL = "symbol, timeframe, timestamp"

# ---------------------------------------------------------------- A15 bars


@query(
    "a15_resample",
    with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in PRICE_COLS) + " FROM o"),
)
def a15_resample(spark, sf):
    return out(event_bars(spark, sf, "1h"), PRICE_COLS)


@query(
    "a15_resample_15m",
    with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in PRICE_COLS) + " FROM o", "15m"),
)
def a15_resample_15m(spark, sf):
    return out(event_bars(spark, sf, "15m"), PRICE_COLS)


# ---------------------------------------------------------------- EMA family

def delta_sql(p: str = "", src: str = "bars") -> str:
    """CTEs ``{p}g0`` / ``{p}g``: close diff and its gain / loss parts."""
    return f"""{p}g0 AS (SELECT *, close - {q.lag('close')} AS delta FROM {src}),
{p}g AS (SELECT *, CASE WHEN delta IS NOT NULL THEN greatest(delta, 0.0) END AS up,
                CASE WHEN delta IS NOT NULL THEN -least(delta, 0.0) END AS dn FROM {p}g0)"""


_DELTA = delta_sql()


@query(
    "c9_ema",
    with_bars(
        f"e AS (SELECT *, {q.ema_span('close', 12)} AS ema12, {q.ema_span('close', 26)} AS ema26 FROM bars)\n"
        f"SELECT {KEYS_SQL}, {q.r('ema12', 'ema12')}, {q.r('ema26', 'ema26')} FROM e"
    ),
)
def c9_ema(spark, sf):
    b = ensure_index(event_bars(spark, sf))
    return out(ewm(b, [Ema.span("ema12", "close", 12), Ema.span("ema26", "close", 26)]), ["ema12", "ema26"])


@query(
    "c10_ema_alpha",
    with_bars(
        f"e AS (SELECT *, {q.ema('close', 1 / 14)} AS ema_w14, {q.ema('volume', 0.8)} AS ema_v08 FROM bars)\n"
        f"SELECT {KEYS_SQL}, {q.r('ema_w14', 'ema_w14')}, {q.r('ema_v08', 'ema_v08')} FROM e"
    ),
)
def c10_ema_alpha(spark, sf):
    b = ensure_index(event_bars(spark, sf))
    d = ewm(b, [Ema("ema_w14", "close", 1 / 14), Ema("ema_v08", "volume", 0.8)])
    return out(d, ["ema_w14", "ema_v08"])


@query(
    "c11_macd",
    with_bars(
        f"e AS (SELECT *, {q.ema_span('close', 12)} - {q.ema_span('close', 26)} AS macd FROM bars),\n"
        f"s AS (SELECT *, {q.ema_span('macd', 9)} AS macd_signal FROM e)\n"
        f"SELECT {KEYS_SQL}, {q.r('macd', 'macd')}, {q.r('macd_signal', 'macd_signal')}, "
        f"{q.r('macd - macd_signal', 'macd_hist')} FROM s"
    ),
)
def c11_macd(spark, sf):
    return out(ind.macd(event_bars(spark, sf)), ["macd", "macd_signal", "macd_hist"])


@query(
    "c12_rsi_wilder",
    with_bars(
        f"""{_DELTA},
e AS (SELECT *, CASE WHEN delta IS NOT NULL THEN {q.ema('up', 1 / 14, True)} END AS au,
                CASE WHEN delta IS NOT NULL THEN {q.ema('dn', 1 / 14, True)} END AS ad FROM g)
SELECT {KEYS_SQL}, {q.r("coalesce(100.0 - 100.0 / (1.0 + au / NULLIF(ad, 0)), 50.0)", "rsi14")} FROM e"""
    ),
)
def c12_rsi_wilder(spark, sf):
    return out(ind.rsi_wilder(event_bars(spark, sf)), ["rsi14"])


_RSI_EMA_SQL = """CASE WHEN au IS NULL OR ad IS NULL THEN NULL
     WHEN ad = 0 THEN CASE WHEN au > 0 THEN 100.0 END
     ELSE 100.0 - 100.0 / (1.0 + au / ad) END"""


@query(
    "c13_rsi_ema",
    with_bars(
        f"""{_DELTA},
e AS (SELECT *, CASE WHEN delta IS NOT NULL THEN {q.ema_span('up', 14, True)} END AS au,
                CASE WHEN delta IS NOT NULL THEN {q.ema_span('dn', 14, True)} END AS ad FROM g)
SELECT {KEYS_SQL}, {q.r(_RSI_EMA_SQL, "rsi")} FROM e"""
    ),
)
def c13_rsi_ema(spark, sf):
    return out(ind.rsi_ema(event_bars(spark, sf)), ["rsi"])


# ---------------------------------------------------------------- E1-E3

def backtest_sql(p: str = "", src: str = "bars", out: str = "bt") -> str:
    """CTEs ending in ``out``: the EMA/RSI rule at every bar of ``src``."""
    return f"""{delta_sql(p, src)},
{p}e AS (SELECT *, {q.ema_span('close', 12)} AS ema12, {q.ema_span('close', 26)} AS ema26,
             CASE WHEN delta IS NOT NULL THEN {q.ema_span('up', 14, True)} END AS au,
             CASE WHEN delta IS NOT NULL THEN {q.ema_span('dn', 14, True)} END AS ad FROM {p}g),
{p}r AS (SELECT *, {_RSI_EMA_SQL} AS rsi FROM {p}e),
{out} AS (SELECT symbol, timeframe, timestamp, close,
  CASE WHEN ema12 > ema26 AND rsi < 70 THEN 'BUY' WHEN ema12 < ema26 AND rsi > 30 THEN 'SELL' ELSE 'NoSignal' END AS signal,
  CASE WHEN ema12 > ema26 AND rsi < 70 THEN least(greatest((70.0 - rsi) / 70.0, 0.0), 1.0)
       WHEN ema12 < ema26 AND rsi > 30 THEN least(greatest((rsi - 30.0) / 70.0, 0.0), 1.0)
       ELSE 0.5 END AS confidence FROM {p}r)"""


_BACKTEST_SQL = backtest_sql()


@query(
    "e1_rule",
    with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, {q.r('ema12', 'ema12')}, {q.r('ema26', 'ema26')}, {q.r('rsi', 'rsi')}, signal, {q.r('confidence', 'confidence')} FROM r JOIN bt USING ({KEYS_SQL})"),
)
def e1_rule(spark, sf):
    """The rule with the averages and the RSI that it decides by."""
    return out(ema_rsi_backtest(event_bars(spark, sf), keep_indicators=True), ["ema12", "ema26", "rsi", "confidence"], ["signal"])


@query(
    "e2_backtest",
    with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')} FROM bt"),
)
def e2_backtest(spark, sf):
    return out(ema_rsi_backtest(event_bars(spark, sf)), ["confidence"], ["signal"])


@query(
    "e3_latest_signal",
    with_bars(
        f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')}, {q.r('close', 'close')} FROM bt "
        "QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY timestamp DESC) = 1"
    ),
)
def e3_latest_signal(spark, sf):
    return out(latest_signal(event_bars(spark, sf)), ["confidence", "close"], ["signal"])


# ---------------------------------------------------------------- C30 bundle

_BUNDLE_SQL = f"""{_DELTA},
e AS (SELECT *,
  coalesce(close / NULLIF({q.lag('close')}, 0) - 1.0, 0.0) AS return1,
  {q.ema_span('close', 12)} AS ema12, {q.ema_span('close', 26)} AS ema26,
  CASE WHEN delta IS NOT NULL THEN {q.ema('up', 1 / 14, True)} END AS au,
  CASE WHEN delta IS NOT NULL THEN {q.ema('dn', 1 / 14, True)} END AS ad,
  greatest(high - low, abs(high - {q.lag('close')}), abs(low - {q.lag('close')})) AS tr,
  sum((high + low + close) / 3.0 * volume) OVER {q.frame(14)} / NULLIF(sum(volume) OVER {q.frame(14)}, 0) AS vwap14,
  sum(coalesce(sign(delta), 0) * volume) OVER {q.frame()} AS obv
  FROM g),
m AS (SELECT *, ema12 - ema26 AS macd, avg(tr) OVER {q.frame(14)} AS atr14 FROM e),
s AS (SELECT *, {q.ema_span('macd', 9)} AS macd_signal FROM m),
f AS (SELECT *, macd - macd_signal AS macd_hist,
  coalesce(100.0 - 100.0 / (1.0 + au / NULLIF(ad, 0)), 50.0) AS rsi14, 0.0 AS spread FROM s)"""


@query(
    "c30_indicator_bundle",
    with_bars(f"{_BUNDLE_SQL}\nSELECT {KEYS_SQL}, " + ", ".join(q.r(c, c) for c in (*PRICE_COLS, *INDICATOR_COLS)) + " FROM f"),
)
def c30_indicator_bundle(spark, sf):
    return out(ind.indicators(event_bars(spark, sf)), [*PRICE_COLS, *INDICATOR_COLS])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> 1h bars -> EMA/RSI rule at every bar -> latest signal per symbol."""
    return e3_latest_signal(spark, sf_dir)
