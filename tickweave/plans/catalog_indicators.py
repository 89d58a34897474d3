"""Registered queries for the indicator operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import indicators as ind
from tickweave.operators.ewm import Ema, ewm
from tickweave.operators.series import ensure_index
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import _BUNDLE_SQL, _DELTA, KEYS_SQL, out, query, with_bars
from tickweave.plans.inputs import event_bars
from tickweave.schema import KEYS, MODEL_FEATURES, PRICE_COLS, TS


def sel(pairs: list[tuple[str, str]], src: str = "bars") -> str:
    """``SELECT keys, round(expr) AS name ... FROM src``."""
    return f"SELECT {KEYS_SQL}, " + ", ".join(q.r(e, n) for n, e in pairs) + f" FROM {src}"


def simple(name: str, pairs: list[tuple[str, str]]):
    return query(name, with_bars(f"o AS (SELECT * FROM bars)\n{sel(pairs, 'o')}"))


def ret(k: int, eps: float | None = None) -> str:
    den = q.lag("close", k) if eps is None else f"({q.lag('close', k)} + {q.d(eps)})"
    return f"close / NULLIF({den}, 0) - 1.0"


@simple("c1_return1", [("return1", ret(1)), ("return1_filled", f"coalesce({ret(1)}, 0.0)")])
def c1_return1(spark, sf):
    d = ind.windowed(event_bars(spark, sf), [[("return1", ind.pct_change("close", 1)), ("return1_filled", F.coalesce(ind.pct_change("close", 1), F.lit(0.0)))]], back=1)
    return out(d, ["return1", "return1_filled"])


_KS = (1, 2, 3, 6, 12, 24)


@simple("c2_returns_k", [(f"return_{k}", ret(k)) for k in _KS] + [(f"return_{k}h", ret(k)) for k in (1, 3, 6, 12)])
def c2_returns_k(spark, sf):
    d = ind.returns(event_bars(spark, sf), _KS)
    d = ind.windowed(d, [[(f"return_{k}h", ind.pct_change("close", k)) for k in (1, 3, 6, 12)]], back=12)
    return out(d, [f"return_{k}" for k in _KS] + [f"return_{k}h" for k in (1, 3, 6, 12)])


@simple("c3_return_eps", [("return_1e", ret(1, 1e-12)), ("return_3e", ret(3, 1e-12))])
def c3_return_eps(spark, sf):
    d = ind.windowed(event_bars(spark, sf), [[("return_1e", ind.pct_change("close", 1, eps=1e-12)), ("return_3e", ind.pct_change("close", 3, eps=1e-12))]], back=3)
    return out(d, ["return_1e", "return_3e"])


@simple("c4_close_lags", [(f"close_lag_{k}", q.lag("close", k)) for k in (1, 2, 3, 6, 12, 24)])
def c4_close_lags(spark, sf):
    return out(ind.lags(event_bars(spark, sf), "close", (1, 2, 3, 6, 12, 24)), [f"close_lag_{k}" for k in (1, 2, 3, 6, 12, 24)])


@query(
    "c5_return_lags",
    with_bars(f"r AS (SELECT *, {ret(1)} AS return1 FROM bars)\n" + sel([(f"return_lag_{k}", q.lag("return1", k)) for k in (1, 2, 3)], "r")),
)
def c5_return_lags(spark, sf):
    d = ind.windowed(event_bars(spark, sf), [[("return1", ind.pct_change("close", 1))], [(f"return_lag_{k}", ind.lag("return1", k)) for k in (1, 2, 3)]], back=4)
    return out(d, [f"return_lag_{k}" for k in (1, 2, 3)])


@simple("c6_sma_partial", [("sma14", q.rolling("avg", "close", 14, 1)), ("sma20", q.rolling("avg", "close", 20, 1))])
def c6_sma_partial(spark, sf):
    """Partial-start SMA14 / SMA20.  (Windows of 32+ rows over these 2-decimal
    prices give means that sit exactly half-way at the 6th decimal, where the
    summation order of each engine decides the rounding of the compare.)"""
    d = ind.windowed(event_bars(spark, sf), [[("sma14", ind.rolling_mean("close", 14, 1)), ("sma20", ind.rolling_mean("close", 20, 1))]], back=19)
    return out(d, ["sma14", "sma20"])


@simple("c7_sma_strict", [("rolling_mean_14", q.rolling("avg", "close", 14)), ("rolling_mean_28", q.rolling("avg", "close", 28)), ("vol_mean_14", q.rolling("avg", "volume", 14))])
def c7_sma_strict(spark, sf):
    d = ind.windowed(event_bars(spark, sf), [[("rolling_mean_14", ind.rolling_mean("close", 14)), ("rolling_mean_28", ind.rolling_mean("close", 28)), ("vol_mean_14", ind.rolling_mean("volume", 14))]], back=27)
    return out(d, ["rolling_mean_14", "rolling_mean_28", "vol_mean_14"])


@simple(
    "c8_rolling_std",
    [
        ("rolling_std_14", q.rolling("stddev_samp", "close", 14)),
        ("rolling_std_28", q.rolling("stddev_samp", "close", 28)),
        ("rolling_std_14_partial", f"coalesce({q.rolling('stddev_samp', 'close', 14, 1)}, 0.0)"),
    ],
)
def c8_rolling_std(spark, sf):
    d = ind.windowed(
        event_bars(spark, sf),
        [[
            ("rolling_std_14", ind.rolling_std("close", 14)),
            ("rolling_std_28", ind.rolling_std("close", 28)),
            ("rolling_std_14_partial", F.coalesce(ind.rolling_std("close", 14, 1), F.lit(0.0))),
        ]],
        back=27,
    )
    return out(d, ["rolling_std_14", "rolling_std_28", "rolling_std_14_partial"])


@query(
    "c14_rsi_rolling",
    with_bars(f"{_DELTA}\n" + sel([("rsi14", f"100.0 - 100.0 / (1.0 + avg(up) OVER {q.frame(14)} / (avg(dn) OVER {q.frame(14)} + {q.d(1e-9)}))")], "g")),
)
def c14_rsi_rolling(spark, sf):
    return out(ind.rsi_rolling(event_bars(spark, sf)), ["rsi14"])


_TA_SQL = f"""{_DELTA},
n AS (SELECT *, row_number() OVER ({q.ORDER}) - 1 AS i,
  list(close) OVER {q.frame()} AS lc, list(up) OVER {q.frame()} AS lu, list(dn) OVER {q.frame()} AS ld FROM g),
t AS (SELECT *,
  {q.rolling('avg', 'close', 20)} AS sma20,
  CASE WHEN i >= 11 THEN list_reduce(list_slice(lc, 13, len(lc)), lambda a, v: a * {q.d(11 / 13)} + v * {q.d(2 / 13)}, list_avg(list_slice(lc, 1, 12))) END AS ema12,
  CASE WHEN i >= 14 THEN list_reduce(list_slice(lu, 16, len(lu)), lambda a, v: a * {q.d(13 / 14)} + v * {q.d(1 / 14)}, list_avg(list_slice(lu, 2, 15))) END AS au,
  CASE WHEN i >= 14 THEN list_reduce(list_slice(ld, 16, len(ld)), lambda a, v: a * {q.d(13 / 14)} + v * {q.d(1 / 14)}, list_avg(list_slice(ld, 2, 15))) END AS ad FROM n)"""


@query("c15_ta_forms", with_bars(f"{_TA_SQL}\n" + sel([("sma20", "sma20"), ("ema12", "ema12"), ("rsi14", "CASE WHEN au + ad = 0 THEN 0.0 ELSE 100.0 * au / (au + ad) END")], "t")))
def c15_ta_forms(spark, sf):
    """SMA20, EMA12 and RSI14 with null warm-up and plain-mean seeds."""
    d = ind.ta_sma(event_bars(spark, sf), "close", 20)
    d = ind.ta_ema(d, "close", 12)
    d = ind.ta_rsi(d, 14)
    return out(d, ["sma20", "ema12", "rsi14"])


_TR = f"greatest(high - low, abs(high - {q.lag('close')}), abs(low - {q.lag('close')}))"


@simple("c16_true_range", [("tr", _TR)])
def c16_true_range(spark, sf):
    return out(ind.windowed(event_bars(spark, sf), [[("tr", ind.true_range())]], back=1), ["tr"])


@query("c17_atr", with_bars(f"t AS (SELECT *, {_TR} AS tr FROM bars)\n" + sel([("atr14", f"avg(tr) OVER {q.frame(14)}")], "t")))
def c17_atr(spark, sf):
    return out(ind.atr(event_bars(spark, sf)), ["atr14"])


@simple("c18_atr_simple", [("atr14_simple", q.rolling("avg", "high - low", 14)), ("atr14_partial", q.rolling("avg", "high - low", 14, 1))])
def c18_atr_simple(spark, sf):
    d = ind.atr_simple(event_bars(spark, sf), 14, True, "atr14_simple")
    d = ind.atr_simple(d, 14, False, "atr14_partial")
    return out(d, ["atr14_simple", "atr14_partial"])


@simple("c19_vwap", [("vwap14", f"sum((high + low + close) / 3.0 * volume) OVER {q.frame(14)} / NULLIF(sum(volume) OVER {q.frame(14)}, 0)")])
def c19_vwap(spark, sf):
    return out(ind.vwap(event_bars(spark, sf)), ["vwap14"])


@simple("c20_vwap_cumulative", [("vwap_cum", f"sum(close * volume) OVER {q.frame()} / (sum(volume) OVER {q.frame()} + {q.d(1e-9)})")])
def c20_vwap_cumulative(spark, sf):
    return out(ind.vwap_cumulative(event_bars(spark, sf), out="vwap_cum"), ["vwap_cum"])


@query("c21_obv", with_bars(f"t AS (SELECT *, coalesce(sign(close - {q.lag('close')}), 0) * volume AS obv_t FROM bars)\n" + sel([("obv", f"sum(obv_t) OVER {q.frame()}")], "t")))
def c21_obv(spark, sf):
    return out(ind.obv(event_bars(spark, sf)), ["obv"])


@simple("c22_spread", [("spread", "(high - low) / NULLIF((high + low) / 2.0, 0)"), ("spread_none", "0.0")])
def c22_spread(spark, sf):
    """Quotes taken as bid = low, ask = high; a frame without them gives 0."""
    b = event_bars(spark, sf)
    d = ind.spread(b.withColumn("bid", F.col("low")).withColumn("ask", F.col("high")))
    d = d.withColumn("spread_none", ind.spread_expr(b))
    return out(d, ["spread", "spread_none"])


@query(
    "c23_volatility",
    with_bars(
        f"""r AS (SELECT *, {ret(1)} AS return1, {q.rolling('stddev_samp', 'close', 14)} AS sd14 FROM bars)
"""
        + sel(
            [
                ("vol_close_std", "sd14"),
                ("vol_return_std", q.rolling("stddev_samp", "return1", 14)),
                ("vol_relative", f"coalesce({q.rolling('stddev_samp', 'close', 14, 1)}, 0.0) / ({q.rolling('avg', 'close', 14, 1)} + {q.d(1e-9)})"),
                ("vol_close_std_bfill", f"first_value(sd14 IGNORE NULLS) OVER ({q.ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"),
            ],
            "r",
        )
    ),
)
def c23_volatility(spark, sf):
    d = ensure_index(event_bars(spark, sf))
    d = ind.volatility(d, "close_std", out="vol_close_std")
    d = ind.volatility(d, "return_std", out="vol_return_std")
    d = ind.volatility(d, "relative", out="vol_relative")
    d = ind.volatility(d, "close_std_bfill", out="vol_close_std_bfill")
    return out(d, ["vol_close_std", "vol_return_std", "vol_relative", "vol_close_std_bfill"])


@simple("c24_momentum", [("momentum14", f"close - {q.lag('close', 14)}")])
def c24_momentum(spark, sf):
    return out(ind.momentum(event_bars(spark, sf)), ["momentum14"])


@simple("c25_price_range", [("price_range", "high - low"), ("price_range_rel", f"(high - low) / (close + {q.d(1e-12)})")])
def c25_price_range(spark, sf):
    d = ind.price_range(event_bars(spark, sf))
    d = ind.price_range(d, relative=True, out="price_range_rel")
    return out(d, ["price_range", "price_range_rel"])


@query(
    "c26_volume_spike",
    with_bars(
        f"m AS (SELECT *, {q.rolling('avg', 'volume', 14)} AS vm FROM bars)\n"
        + f"SELECT {KEYS_SQL}, {q.r('vm', 'vol_mean_14')}, {q.r(f'volume / (vm + {q.d(1e-9)})', 'spike_ratio')}, "
        + f"{q.r('volume / NULLIF(vm, 0) - 1.0', 'spike_minus_one')}, coalesce(CAST(volume > vm * 1.5 AS INTEGER), 0) AS spike_flag FROM m"
    ),
)
def c26_volume_spike(spark, sf):
    b = ensure_index(event_bars(spark, sf))
    d = ind.volume_spike(b, kind="ratio").withColumnRenamed("vol_spike", "spike_ratio")
    d = ind.volume_spike(d.drop("vol_mean_14"), kind="minus_one").withColumnRenamed("vol_spike", "spike_minus_one")
    d = ind.volume_spike(d.drop("vol_mean_14"), kind="flag").withColumnRenamed("vol_spike", "spike_flag")
    return out(d, ["vol_mean_14", "spike_ratio", "spike_minus_one"], ["spike_flag"])


@query(
    "c27_ema_ratio",
    with_bars(
        f"e AS (SELECT *, {q.ema_span('close', 12)} AS ema12, {q.ema_span('close', 26)} AS ema26 FROM bars)\n"
        + sel([("ratio_e9", f"ema12 / NULLIF(ema26 + {q.d(1e-9)}, 0)"), ("ratio_e12", f"ema12 / NULLIF(ema26 + {q.d(1e-12)}, 0)"), ("ratio_plain", "ema12 / NULLIF(ema26, 0)")], "e")
    ),
)
def c27_ema_ratio(spark, sf):
    d = ewm(ensure_index(event_bars(spark, sf)), [Ema.span("ema12", "close", 12), Ema.span("ema26", "close", 26)])
    d = d.select("*", ind.ema_ratio_expr(1e-9).alias("ratio_e9"), ind.ema_ratio_expr(1e-12).alias("ratio_e12"), ind.ema_ratio_expr(None).alias("ratio_plain"))
    return out(d, ["ratio_e9", "ratio_e12", "ratio_plain"])


@query(
    "c28_flags",
    with_bars(
        f"{_BUNDLE_SQL}\nSELECT {KEYS_SQL}, coalesce(CAST(macd > macd_signal AS INTEGER), 0) AS macd_cross, "
        "coalesce(CAST(rsi14 > 70 AS INTEGER), 0) AS rsi_overbought, coalesce(CAST(rsi14 < 30 AS INTEGER), 0) AS rsi_oversold FROM f"
    ),
)
def c28_flags(spark, sf):
    d = ind.flags(ind.indicators(event_bars(spark, sf)))
    return d.select(*KEYS, TS, "macd_cross", "rsi_overbought", "rsi_oversold")


@query(
    "c29_zscore",
    with_bars(
        "s AS (SELECT *, "
        + ", ".join(f"avg({c}) OVER ({q.SERIES}) AS m_{c}, stddev_samp({c}) OVER ({q.SERIES}) AS s_{c}" for c in PRICE_COLS)
        + " FROM bars)\n"
        + sel([(c, f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END") for c in PRICE_COLS], "s")
    ),
)
def c29_zscore(spark, sf):
    return out(ind.zscore(event_bars(spark, sf), list(PRICE_COLS)), list(PRICE_COLS))


# ---------------------------------------------------------------- bundles C31-C33


def _ffbf(c: str) -> str:
    ff = f"last_value({c} IGNORE NULLS) OVER ({q.ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    bf = f"first_value({c} IGNORE NULLS) OVER ({q.ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"coalesce({ff}, {bf})"


_C31_COLS = (
    [f"{p}_{k}" for k in (1, 2, 3, 6, 12, 24) for p in ("close_lag", "return")]
    + ["return1", "rolling_mean_14", "rolling_std_14", "rolling_mean_28", "rolling_std_28", "momentum14", "price_range",
       "vol_mean_14", "price_high_low", "atr14_simple"]
    + [f"return_{w}h" for w in (1, 3, 6, 12)]
    + ["volatility", "vol_spike", "ema12", "ema26", "macd", "macd_signal", "macd_hist", "ema_ratio"]
)


def _c31_sql() -> str:
    raw = []
    for k in (1, 2, 3, 6, 12, 24):
        raw += [(f"close_lag_{k}", q.lag("close", k)), (f"return_{k}", ret(k))]
    raw += [
        ("return1", ret(1)),
        ("rolling_mean_14", q.rolling("avg", "close", 14)), ("rolling_std_14", q.rolling("stddev_samp", "close", 14)),
        ("rolling_mean_28", q.rolling("avg", "close", 28)), ("rolling_std_28", q.rolling("stddev_samp", "close", 28)),
        ("momentum14", f"close - {q.lag('close', 14)}"), ("price_range", "high - low"),
        ("vol_mean_14", q.rolling("avg", "volume", 14)), ("price_high_low", "high - low"),
        ("atr14_simple", q.rolling("avg", "high - low", 14)),
    ] + [(f"return_{w}h", ret(w)) for w in (1, 3, 6, 12)]
    raw += [("ema12", q.ema_span("close", 12)), ("ema26", q.ema_span("close", 26)), ("next_close", q.lead("close"))]
    body = ", ".join(f"{e} AS {n}" for n, e in raw)
    return f"""a AS (SELECT *, {body} FROM bars),
b AS (SELECT *, rolling_std_14 AS volatility, volume / (vol_mean_14 + {q.d(1e-9)}) AS vol_spike, ema12 - ema26 AS macd FROM a),
c AS (SELECT *, {q.ema_span('macd', 9)} AS macd_signal FROM b),
d AS (SELECT *, macd - macd_signal AS macd_hist, ema12 / NULLIF(ema26 + {q.d(1e-9)}, 0) AS ema_ratio FROM c),
f AS (SELECT symbol, timeframe, timestamp, open, high, low, close, volume, next_close, {", ".join(f"{_ffbf(c)} AS {c}" for c in _C31_COLS)} FROM d)
SELECT {KEYS_SQL}, {", ".join(q.r(c, c) for c in (*PRICE_COLS, *_C31_COLS))}, coalesce(CAST(next_close > close AS INTEGER), 0) AS target FROM f"""


@query("c31_recompute_bundle", with_bars(_c31_sql()))
def c31_recompute_bundle(spark, sf):
    """Lags, returns, rolling stats, EMA/MACD, ffill+bfill, next-bar target
    (last row 0: the reference's behaviour)."""
    d = ind.feature_set(event_bars(spark, sf))
    return out(d, [*PRICE_COLS, *_C31_COLS], ["target"])


_C32_COLS = (
    [f"{p}_{k}" for k in (1, 2, 3, 6, 12) for p in ("close_lag", "return")]
    + ["return1", "rolling_mean_14", "rolling_std_14", "momentum14", "price_range", "vol_mean_14", "price_high_low", "atr14_simple",
       "volatility", "vol_spike", "ema12", "ema26", "macd", "macd_signal", "macd_hist", "ema_ratio"]
)


def _c32_sql() -> str:
    raw = []
    for k in (1, 2, 3, 6, 12):
        raw += [(f"close_lag_{k}", q.lag("close", k)), (f"return_{k}", ret(k))]
    raw += [
        ("return1", ret(1)), ("rolling_mean_14", q.rolling("avg", "close", 14)), ("rolling_std_14", q.rolling("stddev_samp", "close", 14)),
        ("momentum14", f"close - {q.lag('close', 14)}"), ("price_range", "high - low"), ("vol_mean_14", q.rolling("avg", "volume", 14)),
        ("price_high_low", "high - low"), ("atr14_simple", q.rolling("avg", "high - low", 14)),
        ("ema12", q.ema_span("close", 12)), ("ema26", q.ema_span("close", 26)),
    ]
    body = ", ".join(f"{e} AS {n}" for n, e in raw)
    return f"""a AS (SELECT *, {body} FROM bars),
b AS (SELECT *, {q.rolling('stddev_samp', 'return1', 14)} AS volatility, volume / NULLIF(vol_mean_14, 0) - 1.0 AS vol_spike, ema12 - ema26 AS macd FROM a),
c AS (SELECT *, {q.ema_span('macd', 9)} AS macd_signal FROM b),
d AS (SELECT *, macd - macd_signal AS macd_hist, ema12 / NULLIF(ema26, 0) AS ema_ratio FROM c)
SELECT {KEYS_SQL}, {", ".join(q.r(f"coalesce({c}, 0.0)", c) for c in (*PRICE_COLS, *_C32_COLS))} FROM d"""


@query("c32_zero_filled_bundle", with_bars(_c32_sql()))
def c32_zero_filled_bundle(spark, sf):
    return out(ind.zero_filled_features(event_bars(spark, sf)), [*PRICE_COLS, *_C32_COLS])


def _c33_sql() -> str:
    raw = []
    for k in (1, 2, 3, 6, 12):
        raw += [(f"close_lag_{k}", q.lag("close", k)), (f"return_{k}", ret(1))]
    raw += [
        ("return1", ret(1)), ("rolling_mean_14", q.rolling("avg", "close", 14, 1)),
        ("rolling_std_14", f"coalesce({q.rolling('stddev_samp', 'close', 14, 1)}, 0.0)"),
        ("momentum14", f"close - {q.lag('close', 14)}"), ("price_range", "high - low"), ("vol_mean_14", q.rolling("avg", "volume", 14, 1)),
        ("price_high_low", "high - low"), ("atr14_simple", q.rolling("avg", "high - low", 14, 1)),
        ("atr14", q.rolling("avg", "high - low", 14, 1)),
        ("rsi14", f"100.0 - 100.0 / (1.0 + avg(up) OVER {q.frame(14)} / (avg(dn) OVER {q.frame(14)} + {q.d(1e-9)}))"),
        ("vwap14", f"sum(close * volume) OVER {q.frame()} / (sum(volume) OVER {q.frame()} + {q.d(1e-9)})"),
        ("ema12", q.ema_span("close", 12)), ("ema26", q.ema_span("close", 26)),
    ]
    body = ", ".join(f"{e} AS {n}" for n, e in raw)
    have = {n for n, _ in raw} | {"volatility", "vol_spike", "macd", "macd_signal", "macd_hist", "ema_ratio", *PRICE_COLS}
    sel_cols = [(c, _ffbf(c) if c not in PRICE_COLS else c) if c in have else (c, "0.0") for c in MODEL_FEATURES]
    return f"""{_DELTA},
a AS (SELECT *, {body} FROM g),
b AS (SELECT *, rolling_std_14 / (rolling_mean_14 + {q.d(1e-9)}) AS volatility, volume / (vol_mean_14 + {q.d(1e-9)}) AS vol_spike, ema12 - ema26 AS macd FROM a),
c AS (SELECT *, {q.ema_span('macd', 9)} AS macd_signal FROM b),
d AS (SELECT *, macd - macd_signal AS macd_hist, ema12 / NULLIF(ema26 + {q.d(1e-9)}, 0) AS ema_ratio FROM c)
SELECT {KEYS_SQL}, {", ".join(q.r(f"coalesce({e}, 0.0)", n) for n, e in sel_cols)} FROM d"""


@query("c33_partial_bundle", with_bars(_c33_sql()))
def c33_partial_bundle(spark, sf):
    """Partial-window bundle aligned to the 36-column model feature list."""
    return out(ind.partial_features(event_bars(spark, sf)), list(MODEL_FEATURES))
