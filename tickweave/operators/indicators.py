"""Technical indicators (C1-C33) over bar series.

Bounded windows (lag, lead, rolling n) run in one halo stage partitioned by
``(keys, _seg)``; unbounded state (EMA, running sums, fills) uses the segment
carries of ``series`` and ``ewm``.  Every expression is a Spark built-in.

pandas conventions kept on purpose:
* ``rolling(n)`` needs ``min_periods`` non-null values (default ``n``); Spark
  window aggregates never enforce that, so results are wrapped in a
  ``count >= m`` guard.
* ``std`` is the sample std (``stddev_samp``).
* division by zero gives null (``try_divide``), never an ANSI error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.core import col_of, safe_div
from tickweave.operators.carry import carry_stage
from tickweave.operators.ewm import Ema, EmaOfEmas, ewm, may_be_null
from tickweave.operators.series import (
    IDX,
    SEG,
    ensure_index,
    fill_backward,
    fill_forward,
    keys_of,
    main_rows,
    rows_back,
    running_sum,
    seg_window,
    with_halo,
    with_halo_local,
)
from tickweave.schema import KEYS, PRICE_COLS, TS

Stage = Sequence[tuple[str, Column]]


# ---------------------------------------------------------------- expressions
# These assume the halo layout (``with_halo``) and the shared window.


def lag(c, k: int, keys=KEYS) -> Column:
    return F.lag(col_of(c), k).over(seg_window(keys))


def lead(c, k: int, keys=KEYS) -> Column:
    return F.lead(col_of(c), k).over(seg_window(keys))


def pct_change(c, k: int = 1, keys=KEYS, eps: float | None = None) -> Column:
    """``c / lag(c, k) - 1`` (``eps`` added to the divisor for C3)."""
    prev = lag(c, k, keys)
    if eps is not None:
        prev = prev + F.lit(eps)
    return safe_div(col_of(c), prev) - F.lit(1.0)


def rolling(agg: Callable[[Column], Column], c, n: int, min_periods: int | None = None, keys=KEYS) -> Column:
    """pandas ``rolling(n, min_periods).agg()`` over the current and n-1 prior rows."""
    w = rows_back(n, keys)
    m = n if min_periods is None else min_periods
    return F.when(F.count(col_of(c)).over(w) >= F.lit(m), agg(col_of(c)).over(w))


def rolling_mean(c, n: int, min_periods: int | None = None, keys=KEYS) -> Column:
    return rolling(F.avg, c, n, min_periods, keys)


def rolling_std(c, n: int, min_periods: int | None = None, keys=KEYS) -> Column:
    # Sample std needs two values; pandas gives NaN for one, and so does Spark.
    return rolling(F.stddev_samp, c, n, min_periods, keys)


def rolling_sum(c, n: int, min_periods: int | None = None, keys=KEYS) -> Column:
    return rolling(F.sum, c, n, min_periods, keys)


def true_range(keys=KEYS) -> Column:
    """max(h-l, |h-prev close|, |l-prev close|); null terms are skipped."""
    prev = lag("close", 1, keys)
    return F.greatest(
        F.col("high") - F.col("low"),
        F.abs(F.col("high") - prev),
        F.abs(F.col("low") - prev),
    )


def windowed(
    df: DataFrame,
    stages: Sequence[Stage],
    back: int = 0,
    fwd: int = 0,
    keys=KEYS,
    seg_rows: int | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """Run window stages in one halo layout and return the series rows.

    ``stages`` is a list of ``[(name, expr), ...]``; later stages may use the
    columns of earlier ones (e.g. true range, then its rolling mean).
    ``partitioned``: the input comes hash partitioned on ``(keys, _seg)``
    (``regularise``, a carry stage); the halo is then joined in per segment
    (``with_halo_local``) instead of re-shuffling every row.
    """
    if partitioned:
        d = with_halo_local(df, back, fwd, seg_rows, keys)
    else:
        d = with_halo(ensure_index(df, keys), back, fwd, seg_rows)
    for stage in stages:
        d = d.select("*", *[e.alias(n) for n, e in stage])
    return main_rows(d)


# ---------------------------------------------------------------- operators


def returns(df: DataFrame, ks: Sequence[int] = (1,), keys=KEYS, name: str = "return_{k}", first_zero: bool = False):
    """K-bar returns.  ``first_zero`` gives 0 where there is no prior bar."""
    stage = []
    for k in ks:
        e = pct_change("close", k, keys)
        stage.append((name.format(k=k), F.coalesce(e, F.lit(0.0)) if first_zero else e))
    return windowed(df, [stage], back=max(ks), keys=keys)


def lags(df: DataFrame, col: str = "close", ks: Sequence[int] = (1,), keys=KEYS, name: str = "{c}_lag_{k}"):
    """Lagged values."""
    stage = [(name.format(c=col, k=k), lag(col, k, keys)) for k in ks]
    return windowed(df, [stage], back=max(ks), keys=keys)


def sma(df: DataFrame, col: str = "close", n: int = 14, min_periods: int | None = 1, out: str | None = None, keys=KEYS):
    """C6 (``min_periods=1``) / C7 (``min_periods=None`` means n, strict)."""
    out = out or f"sma{n}"
    return windowed(df, [[(out, rolling_mean(col, n, min_periods, keys))]], back=n - 1, keys=keys)


def rolling_stdev(df, col="close", n=14, min_periods=None, out=None, fill_zero=False, keys=KEYS):
    """Rolling sample std, strict or partial (partial + ``fill_zero`` = null to 0)."""
    e = rolling_std(col, n, min_periods, keys)
    if fill_zero:
        e = F.coalesce(e, F.lit(0.0))
    return windowed(df, [[(out or f"rolling_std_{n}", e)]], back=n - 1, keys=keys)


def ema(df: DataFrame, col: str = "close", span: float = 12, out: str | None = None, keys=KEYS, max_block=None, gaps: bool | None = None):
    """EMA with ``alpha = 2/(span+1)``, seeded with the first value.

    ``gaps``: whether the column may hold nulls, weighed as pandas does; None takes it
    from the schema.  ``gaps=False`` is the quicker plan for a filled column whose schema
    does not say so; a null then fails the job.
    """
    return _ewm(ensure_index(df, keys), [Ema.span(out or f"ema{int(span)}", col, span)], keys, max_block, may_be_null(df, [col], gaps))


def ema_alpha(df: DataFrame, col: str, alpha: float, out: str, keys=KEYS, start: int = 0, max_block=None, gaps: bool | None = None):
    """EMA with a general smoothing factor (Wilder: ``1/period``); ``gaps`` as in ``ema``."""
    return _ewm(ensure_index(df, keys), [Ema(out, col, alpha, start)], keys, max_block, may_be_null(df, [col], gaps))


def _ewm(d: DataFrame, specs, keys, max_block, gaps: bool, **stage) -> DataFrame:
    return ewm(d, [replace(s, gaps=gaps) for s in specs], keys, max_block=max_block, **stage)


def macd(df: DataFrame, fast=12, slow=26, signal=9, keys=KEYS, max_block=None, gaps: bool | None = None):
    """C11: MACD line, signal (an EMA of the line) and histogram; ``gaps`` as in ``ema``."""
    d = ensure_index(df, keys)
    fast_slow = [Ema.span("_ema_fast", "close", fast), Ema.span("_ema_slow", "close", slow)]
    d = _emas_with_signal(d, keys, fast_slow, "macd_signal", signal, max_block, may_be_null(df, ["close"], gaps))
    d = d.withColumn("macd", F.col("_ema_fast") - F.col("_ema_slow"))
    return d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop("_ema_fast", "_ema_slow")


def _emas_with_signal(d, keys, fast_slow, signal_out, signal_span, max_block, gaps: bool, emas=(), **stage):
    """EMAs fast/slow and the EMA of their difference: in one carry stage, or, over
    inputs with nulls, the signal in a stage of its own."""
    f, s_ = fast_slow[0].out, fast_slow[1].out
    emas = [replace(e, gaps=gaps) for e in (*fast_slow, *emas)]
    if not gaps:
        return carry_stage(d, keys, emas=emas, ema_combos=[EmaOfEmas.span(signal_out, {f: 1.0, s_: -1.0}, signal_span)], max_block=max_block, **stage)
    d = carry_stage(d, keys, emas=emas, max_block=max_block, **stage).withColumn("_diff", F.col(f) - F.col(s_))
    return ewm(d, [Ema.span(signal_out, "_diff", signal_span, gaps=True)], keys, max_block=max_block).drop("_diff")


def gain_loss(delta: Column) -> tuple[Column, Column]:
    """pandas ``clip``: null stays null (``greatest`` alone would skip it)."""
    up = F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))
    down = F.when(delta.isNotNull(), -F.least(delta, F.lit(0.0)))
    return up, down


def _up_down(keys) -> Stage:
    up, down = gain_loss(F.col("close") - lag("close", 1, keys))
    return [("_up", up), ("_down", down)]


def rsi_wilder(df: DataFrame, period: int = 14, out: str = "rsi14", keys=KEYS, max_block=None, gaps: bool | None = None):
    """Wilder RSI; averages seed on the first diff (row 2); no loss -> 50; ``gaps`` as in ``ema``."""
    d = windowed(df, [_up_down(keys)], back=1, keys=keys)
    d = _ewm(d, [Ema.com("_au", "_up", period, start=1), Ema.com("_ad", "_down", period, start=1)], keys, max_block, may_be_null(df, ["close"], gaps), partitioned=True)
    rs = F.col("_au") / F.when(F.col("_ad") != 0, F.col("_ad"))
    rsi = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)
    return d.withColumn(out, F.coalesce(rsi, F.lit(50.0))).drop("_up", "_down", "_au", "_ad")


def rsi_ema_expr(up: Column, down: Column) -> Column:
    """C13 value from its two averages: u/0 -> 100, 0/0 -> null."""
    return (
        F.when(down.isNull() | up.isNull(), F.lit(None).cast("double"))
        .when(down == 0, F.when(up > 0, F.lit(100.0)))
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + up / down))
    )


def rsi_ema(df: DataFrame, span: float = 14, out: str = "rsi", keys=KEYS, max_block=None, gaps: bool | None = None):
    """RSI with EMA(span) averages (strategy form), no zero guard."""
    d = windowed(df, [_up_down(keys)], back=1, keys=keys)
    d = _ewm(d, [Ema.span("_au", "_up", span, start=1), Ema.span("_ad", "_down", span, start=1)], keys, max_block, may_be_null(df, ["close"], gaps), partitioned=True)
    return d.withColumn(out, rsi_ema_expr(F.col("_au"), F.col("_ad"))).drop("_up", "_down", "_au", "_ad")


def rsi_rolling_expr(n: int, keys=KEYS, eps: float = 1e-9) -> Column:
    """C14: RSI from rolling means of gains/losses (partial windows), eps in the divisor."""
    up, down = gain_loss(F.col("close") - lag("close", 1, keys))
    w = rows_back(n, keys)
    rs = F.avg(up).over(w) / (F.avg(down).over(w) + F.lit(eps))
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)


def rsi_rolling(df: DataFrame, n: int = 14, out: str = "rsi14", keys=KEYS):
    """C14 operator.  The diff needs one bar more than the window."""
    return windowed(df, [[(out, rsi_rolling_expr(n, keys))]], back=n, keys=keys)


def ta_sma(df, col="close", n=20, out=None, keys=KEYS):
    """C15 SMA: strict window, null warm-up."""
    return sma(df, col, n, None, out or f"sma{n}", keys)


def ta_ema(df, col="close", n=12, out=None, keys=KEYS, max_block=None, gaps: bool | None = None):
    """C15 EMA (SMA seed): null for the first n-1 rows, row n-1 = mean of the
    first n values, then the usual recursion with ``alpha = 2/(n+1)``.

    Seeding with the mean is the same as seeding with ``x_{n-1}`` replaced by
    that mean, so the input is rewritten on one row and the blocked EMA starts
    there.  Nulls (``gaps`` as in ``ema``): the mean is over the values among the first n
    rows, the first later value seeds if there are none, and later nulls keep the average.
    """
    out = out or f"ema{n}"
    d = windowed(df, [[("_seed_in", F.when(F.col(IDX) == n - 1, F.avg(col).over(rows_back(n, keys))).otherwise(F.col(col)))]], back=n - 1, keys=keys)
    d = _ewm(d, [Ema.span(out, "_seed_in", n, start=n - 1)], keys, max_block, may_be_null(df, [col], gaps))
    return d.drop("_seed_in")


def ta_rsi(df, n=14, out="rsi14", keys=KEYS, max_block=None, gaps: bool | None = None):
    """C15 RSI: gains/losses averaged Wilder-style, seeded with the plain mean of
    the first n diffs (rows 1..n); null before row n.  Zero loss gives 100.  ``gaps``
    as in ``ta_ema``."""
    d = windowed(df, [_up_down(keys)], back=1, keys=keys)
    d = windowed(
        d,
        [[
            ("_u_in", F.when(F.col(IDX) == n, F.avg("_up").over(rows_back(n, keys))).otherwise(F.col("_up"))),
            ("_d_in", F.when(F.col(IDX) == n, F.avg("_down").over(rows_back(n, keys))).otherwise(F.col("_down"))),
        ]],
        back=n - 1,
        keys=keys,
    )
    d = _ewm(d, [Ema.com("_au", "_u_in", n, start=n), Ema.com("_ad", "_d_in", n, start=n)], keys, max_block, may_be_null(df, ["close"], gaps))
    total = F.col("_au") + F.col("_ad")
    rsi = F.when(total == 0, F.lit(0.0)).otherwise(F.lit(100.0) * F.col("_au") / total)
    return d.withColumn(out, F.when(F.col("_ad") == 0, F.when(F.col("_au") > 0, F.lit(100.0)).otherwise(rsi)).otherwise(rsi)).drop(
        "_up", "_down", "_u_in", "_d_in", "_au", "_ad"
    )


def atr(df: DataFrame, n: int = 14, out: str = "atr14", keys=KEYS):
    """C16 + C17: partial rolling mean of the true range."""
    return windowed(df, [[("_tr", true_range(keys))], [(out, rolling_mean("_tr", n, 1, keys))]], back=n, keys=keys).drop("_tr")


def atr_simple(df: DataFrame, n: int = 14, strict: bool = True, out: str = "atr14_simple", keys=KEYS):
    """Rolling mean of high-low, strict or partial."""
    hl = F.col("high") - F.col("low")
    return windowed(df, [[("_hl", hl)], [(out, rolling_mean("_hl", n, None if strict else 1, keys))]], back=n - 1, keys=keys).drop("_hl")


def vwap_expr(n: int, keys=KEYS) -> Column:
    """Rolling sum of typical price x volume over rolling volume."""
    tp = (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)
    w = rows_back(n, keys)
    return safe_div(F.sum(tp * F.col("volume")).over(w), F.sum("volume").over(w))


def vwap(df: DataFrame, n: int = 14, out: str = "vwap14", keys=KEYS):
    return windowed(df, [[(out, vwap_expr(n, keys))]], back=n - 1, keys=keys)


def vwap_cumulative(df: DataFrame, out: str = "vwap14", eps: float = 1e-9, keys=KEYS):
    """C20: cumulative close x volume over cumulative volume (+eps)."""
    d = running_sum(ensure_index(df, keys), {"_cpv": F.col("close") * F.col("volume"), "_cv": F.col("volume")}, keys)
    return d.withColumn(out, F.col("_cpv") / (F.col("_cv") + F.lit(eps))).drop("_cpv", "_cv")


def obv(df: DataFrame, out: str = "obv", keys=KEYS):
    """Running sum of sign(close diff) x volume; the first row is 0."""
    d = windowed(df, [[("_obv_t", F.coalesce(F.signum(F.col("close") - lag("close", 1, keys)), F.lit(0.0)) * F.col("volume"))]], back=1, keys=keys)
    return running_sum(d, {out: F.col("_obv_t")}, keys, partitioned=True).drop("_obv_t")


def spread_expr(df: DataFrame, bid: str = "bid", ask: str = "ask") -> Column:
    """(ask - bid) / mid, or 0 when the quote columns are missing."""
    if bid in df.columns and ask in df.columns:
        return safe_div(F.col(ask) - F.col(bid), (F.col(ask) + F.col(bid)) / F.lit(2.0))
    return F.lit(0.0)


def spread(df: DataFrame, bid: str = "bid", ask: str = "ask", out: str = "spread"):
    return df.withColumn(out, spread_expr(df, bid, ask))


def volatility(df, kind: str = "close_std", n: int = 14, out: str = "volatility", eps: float = 1e-9, keys=KEYS):
    """Four definitions.

    ``close_std``: strict std of close; ``return_std``: strict std of the one-bar
    return; ``relative``: partial std (null to 0) over partial mean + eps;
    ``close_std_bfill``: strict std of close, back-filled.
    """
    if kind == "close_std":
        return rolling_stdev(df, "close", n, None, out, keys=keys)
    if kind == "close_std_bfill":
        d = rolling_stdev(df, "close", n, None, out, keys=keys)
        return fill_backward(d, [out], keys).drop(SEG)
    if kind == "return_std":
        d = windowed(df, [[("_r1", pct_change("close", 1, keys))], [(out, rolling_std("_r1", n, None, keys))]], back=n, keys=keys)
        return d.drop("_r1")
    if kind == "relative":
        sd = F.coalesce(rolling_std("close", n, 1, keys), F.lit(0.0))
        return windowed(df, [[(out, sd / (rolling_mean("close", n, 1, keys) + F.lit(eps)))]], back=n - 1, keys=keys)
    raise ValueError(kind)


def momentum(df, n: int = 14, out: str | None = None, keys=KEYS):
    """Close minus close n bars back."""
    return windowed(df, [[(out or f"momentum{n}", F.col("close") - lag("close", n, keys))]], back=n, keys=keys)


def price_range(df, relative: bool = False, eps: float = 1e-12, out: str = "price_range"):
    """High - low, or (high - low) / (close + eps)."""
    e = F.col("high") - F.col("low")
    return df.withColumn(out, e / (F.col("close") + F.lit(eps)) if relative else e)


def volume_spike(df, n: int = 14, kind: str = "ratio", eps: float = 1e-9, keys=KEYS):
    """``ratio`` v/(mean+eps), ``minus_one`` v/mean - 1, ``flag`` v > 1.5 mean."""
    m = rolling_mean("volume", n, None, keys)
    if kind == "ratio":
        e = F.col("volume") / (m + F.lit(eps))
    elif kind == "minus_one":
        e = safe_div(F.col("volume"), m) - F.lit(1.0)
    elif kind == "flag":
        e = F.coalesce((F.col("volume") > m * F.lit(1.5)).cast("int"), F.lit(0))
    else:
        raise ValueError(kind)
    return windowed(df, [[(f"vol_mean_{n}", m)], [("vol_spike", e)]], back=n - 1, keys=keys)


def ema_ratio_expr(eps: float | None = 1e-9) -> Column:
    """ema12 / (ema26 + eps); ``eps=None`` is the plain ratio."""
    den = F.col("ema26") if eps is None else F.col("ema26") + F.lit(eps)
    return safe_div(F.col("ema12"), den)


def flags(df) -> DataFrame:
    """MACD above signal, RSI over 70, RSI under 30 (nulls give 0)."""
    return df.select(
        "*",
        F.coalesce((F.col("macd") > F.col("macd_signal")).cast("int"), F.lit(0)).alias("macd_cross"),
        F.coalesce((F.col("rsi14") > 70).cast("int"), F.lit(0)).alias("rsi_overbought"),
        F.coalesce((F.col("rsi14") < 30).cast("int"), F.lit(0)).alias("rsi_oversold"),
    )


def zscore(df: DataFrame, cols: Sequence[str], keys=KEYS, one_on_zero: bool = True) -> DataFrame:
    """Per-series z-score with sample std; a zero std becomes 1.

    Statistics come from a grouped aggregate (partial aggregation, one row per
    series) joined back on the series key; AQE broadcasts it when measured small.
    """
    keys = keys_of(keys)
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols]
    )
    d = df.join(stats, keys, "left")
    out = []
    for c in cols:
        s = F.col(f"_s_{c}")
        if one_on_zero:
            s = F.when(s == 0, F.lit(1.0)).otherwise(s)
        out.append(((F.col(c) - F.col(f"_m_{c}")) / s).alias(c))
    rest = [c for c in df.columns if c not in cols]
    return d.select(*rest, *out).select(*df.columns)


# ---------------------------------------------------------------- bundles


def fill_chain(df: DataFrame, cols: Sequence[str], keys=KEYS, backfill: bool = True, zero: bool = True) -> DataFrame:
    """Ffill, then bfill, then 0, in one carry stage (``backfill=False``
    keeps it causal)."""
    from tickweave.operators.carry import carry_stage

    cols = [c for c in cols if c in df.columns]
    if backfill:
        d = carry_stage(ensure_index(df, keys), keys, fill_chain=cols, fill_value=0.0 if zero else None)
    else:
        d = carry_stage(ensure_index(df, keys), keys, ffill=cols)
        if zero:
            d = d.na.fill(0.0, subset=cols)
    return d.drop(SEG)


def indicators(
    df: DataFrame, keys=KEYS, fill: bool = True, backfill: bool = True, max_block=None, next_close: bool = False, partitioned: bool = False, gaps: bool | None = None
) -> DataFrame:
    """The 11-column indicator table on OHLCV bars.

    return1 (first 0), ema12, ema26, macd/signal/hist, Wilder rsi14, atr14,
    vwap14, obv, spread; then ffill, bfill, 0 over all columns.

    Plan: one halo exchange on (keys, _seg) for every bounded window, then
    one carry stage for the four EMAs, the MACD signal (an EMA of two of them,
    solved in the same stage, see ``carry._combo``), OBV and the fill chain.
    The fill runs on the input and window columns.  The EMA / MACD / RSI outputs
    are null only before the first value of ``close``, where a back-fill would
    give the averages that value and the MACD columns 0, so this equals filling
    everything at the end.

    ``gaps``: whether ``close`` may hold nulls, weighed by the averages as pandas does;
    None takes it from the schema.  ``gaps=False``, for filled bars whose schema does
    not say so, is the one-stage plan above; with nulls the MACD signal takes a
    stage of its own.

    ``next_close=True`` adds ``future_close`` (the next bar's input close,
    null on the last bar) from the same halo stage, for the leakage checks;
    it is not filled.  ``partitioned=True`` when the input comes from
    ``regularise`` (or another carry stage): the halo is joined in per
    segment and the bundle shuffles no full-size data at all.
    """
    keys = keys_of(keys)
    prev = lag("close", 1, keys)
    delta = F.col("close") - prev
    tp = (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)
    w14 = rows_back(14, keys)
    d = windowed(
        df,
        [
            [
                ("return1", F.coalesce(safe_div(F.col("close"), prev) - F.lit(1.0), F.lit(0.0))),
                ("_tr", true_range(keys)),
                ("_up", gain_loss(delta)[0]),
                ("_down", gain_loss(delta)[1]),
                ("_obv_t", F.coalesce(F.signum(delta), F.lit(0.0)) * F.col("volume")),
                ("vwap14", safe_div(F.sum(tp * F.col("volume")).over(w14), F.sum("volume").over(w14))),
            ],
            [("atr14", rolling_mean("_tr", 14, 1, keys))]
            + ([("future_close", lead("close", 1, keys))] if next_close else []),
        ],
        back=14,
        fwd=1 if next_close else 0,
        keys=keys,
        partitioned=partitioned,
    )
    base = [c for c in df.columns if c not in (*keys, TS, IDX, SEG)]
    fill_cols = [*base, "return1", "atr14", "vwap14"] if fill else []
    gaps = may_be_null(df, ["close"], gaps)
    d = _emas_with_signal(
        d,
        keys,
        [Ema.span("ema12", "close", 12), Ema.span("ema26", "close", 26)],
        "macd_signal",
        9,
        max_block,
        gaps,
        sums={"obv": F.col("_obv_t")},
        emas=[Ema.com("_au", "_up", 14, start=1), Ema.com("_ad", "_down", 14, start=1)],
        fill_chain=fill_cols if backfill else [],
        ffill=fill_cols if not backfill else [],
    )
    if gaps and fill:  # rows before the first close
        first = F.col("close") if backfill else F.lit(0.0)
        d = d.withColumns({"ema12": F.coalesce("ema12", first), "ema26": F.coalesce("ema26", first), "macd_signal": F.coalesce("macd_signal", F.lit(0.0))})
    d = d.withColumn("macd", F.col("ema12") - F.col("ema26"))
    rs = F.col("_au") / F.when(F.col("_ad") != 0, F.col("_ad"))
    d = d.select(
        *[c for c in d.columns if not c.startswith("_") or c == IDX],
        (F.col("macd") - F.col("macd_signal")).alias("macd_hist"),
        F.coalesce(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs), F.lit(50.0)).alias("rsi14"),
        spread_expr(df).alias("spread"),
    )
    order = [*keys, TS, *base, "return1", "ema12", "ema26", "macd", "macd_signal", "macd_hist", "rsi14", "atr14", "vwap14", "obv", "spread", "future_close", IDX]
    d = d.select(*[c for c in order if c in d.columns])
    if fill and not backfill:
        d = d.na.fill(0.0, subset=fill_cols)
    return d


def feature_set(
    df: DataFrame,
    keys=KEYS,
    lags_: Sequence[int] = (1, 2, 3, 6, 12, 24),
    windows: Sequence[int] = (14, 28),
    hourly: Sequence[int] = (1, 3, 6, 12),
    min_periods: int | None = None,
    volatility_kind: str = "close_std",
    vol_spike: str = "ratio",
    ema_ratio_eps: float | None = 1e-9,
    fill: str = "ffill_bfill",
    one_bar_returns: bool = False,
    target: bool = True,
    last_row: str = "zero",
    extra: Sequence[tuple[str, Column]] = (),
    extra_back: int = 0,
    cumulative_vwap: bool = False,
    max_block=None,
    gaps: bool | None = None,
) -> DataFrame:
    """The recompute bundle as one function with a spec.

    Lags ``close_lag_k``/``return_k``; ``return1``; rolling mean/std per window;
    volatility; momentum14; price range; volume mean/spike; EMA 12/26, MACD
    triple, ema_ratio; ``price_high_low``; ``atr14_simple``; ``return_{w}h``.
    ``min_periods=None`` is strict (C31/C32), ``1`` partial (C33).
    ``fill``: ``ffill_bfill`` (C31, leaks the future into warm-up rows),
    ``ffill`` (causal), ``zero`` (C32), ``none``.  ``one_bar_returns`` is the
    variant where every ``return_k`` is the one-bar return.  ``target`` adds the
    next-bar up/down label; ``last_row='zero'`` matches the reference (the
    last row gets 0), ``'drop'`` removes it.  ``gaps`` as in ``indicators``.
    """
    keys = keys_of(keys)
    mp = min_periods
    back = max([*lags_, *hourly, *windows, 14, 1, extra_back])
    stage1: list[tuple[str, Column]] = list(extra)
    for k in lags_:
        stage1.append((f"close_lag_{k}", lag("close", k, keys)))
        stage1.append((f"return_{k}", pct_change("close", 1 if one_bar_returns else k, keys)))
    stage1.append(("return1", pct_change("close", 1, keys)))
    for w in windows:
        stage1.append((f"rolling_mean_{w}", rolling_mean("close", w, mp, keys)))
        sd = rolling_std("close", w, mp, keys)
        stage1.append((f"rolling_std_{w}", F.coalesce(sd, F.lit(0.0)) if mp == 1 else sd))
    stage1 += [
        ("momentum14", F.col("close") - lag("close", 14, keys)),
        ("price_range", F.col("high") - F.col("low")),
        ("vol_mean_14", rolling_mean("volume", 14, mp, keys)),
        ("price_high_low", F.col("high") - F.col("low")),
        ("atr14_simple", rolling_mean(F.col("high") - F.col("low"), 14, mp, keys)),
    ]
    for w in hourly:
        stage1.append((f"return_{w}h", pct_change("close", w, keys)))
    if target:
        stage1.append(("_next_close", lead("close", 1, keys)))
    stage2: list[tuple[str, Column]] = []
    if volatility_kind == "close_std":
        stage2.append(("volatility", F.col("rolling_std_14")))
    elif volatility_kind == "return_std":
        stage2.append(("volatility", rolling_std("return1", 14, mp, keys)))
    elif volatility_kind == "relative":
        stage2.append(("volatility", F.col("rolling_std_14") / (F.col("rolling_mean_14") + F.lit(1e-9))))
    if vol_spike == "ratio":
        stage2.append(("vol_spike", F.col("volume") / (F.col("vol_mean_14") + F.lit(1e-9))))
    elif vol_spike == "minus_one":
        stage2.append(("vol_spike", safe_div(F.col("volume"), F.col("vol_mean_14")) - F.lit(1.0)))
    d = windowed(df, [stage1, stage2], back=back, fwd=1 if target else 0, keys=keys)
    sums = {"_cpv": F.col("close") * F.col("volume"), "_cv": F.col("volume")} if cumulative_vwap else {}
    # One carry stage: EMA 12/26, the MACD signal (solved in the same stage if
    # there are no gaps), cumulative sums and the fill of every window column
    # (the averages are null only before the first close).
    gaps = may_be_null(df, ["close"], gaps)
    value_cols = [c for c in d.columns if c not in (*keys, TS, IDX, SEG, "_next_close")]
    fill_cols = value_cols if fill in ("ffill_bfill", "ffill") else []
    d = _emas_with_signal(
        d, keys, [Ema.span("ema12", "close", 12), Ema.span("ema26", "close", 26)], "macd_signal", 9, max_block, gaps,
        sums=sums, fill_chain=fill_cols if fill == "ffill_bfill" else [], ffill=fill_cols if fill == "ffill" else [],
        fill_value=None, partitioned=True,
    )
    if cumulative_vwap:
        d = d.withColumn("vwap14", F.col("_cpv") / (F.col("_cv") + F.lit(1e-9))).drop("_cpv", "_cv")
    if gaps and fill == "ffill_bfill":
        first = F.when(F.col("close").isNotNull(), F.lit(0.0))
        d = d.withColumns({"ema12": F.coalesce("ema12", "close"), "ema26": F.coalesce("ema26", "close"), "macd_signal": F.coalesce("macd_signal", first)})
    d = d.withColumn("macd", F.col("ema12") - F.col("ema26"))
    d = d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).withColumn("ema_ratio", ema_ratio_expr(ema_ratio_eps))
    value_cols = [c for c in d.columns if c not in (*keys, TS, IDX, SEG, "_next_close")]
    if fill == "ffill_bfill":
        d = d.na.drop(subset=value_cols)
    elif fill == "zero":
        d = d.na.fill(0.0, subset=value_cols)
    if target:
        up = (F.col("_next_close") > F.col("close")).cast("int")
        if last_row == "zero":
            d = d.withColumn("target", F.coalesce(up, F.lit(0)))
        else:
            d = d.filter(F.col("_next_close").isNotNull()).withColumn("target", up)
        d = d.drop("_next_close")
    return d.drop(SEG)


def zero_filled_features(df: DataFrame, keys=KEYS, max_block=None, gaps: bool | None = None) -> DataFrame:
    """Strict windows, ``return_k = pct_change(k)``, volatility = std of
    return1, ``vol_spike = v/mean - 1``, plain ema_ratio, all nulls to 0."""
    return feature_set(
        df, keys, lags_=(1, 2, 3, 6, 12), windows=(14,), hourly=(), volatility_kind="return_std",
        vol_spike="minus_one", ema_ratio_eps=None, fill="zero", target=False, max_block=max_block, gaps=gaps,
    )


def partial_features(df: DataFrame, features: Sequence[str] | None = None, keys=KEYS, max_block=None, gaps: bool | None = None) -> DataFrame:
    """Partial windows (``min_periods=1``), rolling-mean RSI with eps,
    cumulative VWAP, ATR as the partial mean of high-low, ffill + bfill, then
    aligned to a model's feature list (B15; default the 36-column set).

    ``return_k`` here is the one-bar return for every k, as in the reference
    (``one_bar_returns=True``).
    """
    from tickweave.operators.clean import align_features
    from tickweave.schema import MODEL_FEATURES

    hl = F.col("high") - F.col("low")
    d = feature_set(
        df, keys, lags_=(1, 2, 3, 6, 12), windows=(14,), hourly=(), min_periods=1,
        volatility_kind="relative", vol_spike="ratio", ema_ratio_eps=1e-9, fill="ffill_bfill",
        one_bar_returns=True, target=False, cumulative_vwap=True,
        extra=[("rsi14", rsi_rolling_expr(14, keys)), ("atr14", rolling_mean(hl, 14, 1, keys))],
        extra_back=14, max_block=max_block, gaps=gaps,
    )
    return align_features(d, list(features or MODEL_FEATURES), keep=[*keys_of(keys), TS])
