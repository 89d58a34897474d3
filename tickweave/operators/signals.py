"""Rule signals, backtest and signal post-processing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.operators.bars import latest_per_series
from tickweave.operators.ewm import Ema, ewm, may_be_null
from tickweave.operators.indicators import gain_loss, lag, rsi_ema_expr, windowed
from tickweave.operators.series import keys_of
from tickweave.schema import KEYS, TS

BUY, SELL, NOSIGNAL, HOLD = "BUY", "SELL", "NoSignal", "HOLD"


def clip01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def rule_expr(ema_fast: Column, ema_slow: Column, rsi: Column) -> tuple[Column, Column]:
    """E1 decision on one row: (signal, confidence).

    fast > slow and rsi < 70 -> BUY, clip((70 - rsi)/70); fast < slow and
    rsi > 30 -> SELL, clip((rsi - 30)/70); otherwise NoSignal, 0.5.  A null
    RSI fails both tests, like NaN.
    """
    buy = (ema_fast > ema_slow) & (rsi < 70)
    sell = (ema_fast < ema_slow) & (rsi > 30)
    signal = F.when(buy, F.lit(BUY)).when(sell, F.lit(SELL)).otherwise(F.lit(NOSIGNAL))
    conf = (
        F.when(buy, clip01((F.lit(70.0) - rsi) / F.lit(70.0)))
        .when(sell, clip01((rsi - F.lit(30.0)) / F.lit(70.0)))
        .otherwise(F.lit(0.5))
    )
    return signal, conf


def ema_rsi_backtest(bars: DataFrame, keys=KEYS, max_block=None, keep_indicators: bool = False, partitioned: bool = False, gaps: bool | None = None) -> DataFrame:
    """E1 at every bar = E2 backtest, all series in one job.

    The reference re-runs the rule on every prefix (O(n^2)).  Every input of
    the rule is causal (EMAs and RSI at row t use rows <= t), so one pass
    gives the same answer for all rows: ``signal, confidence`` per bar.  Closes may be
    null (``gaps`` as in ``indicators``); a bar without averages yet gives NoSignal.
    """
    keys = keys_of(keys)
    up, down = gain_loss(F.col("close") - lag("close", 1, keys))
    d = windowed(bars, [[("_up", up), ("_down", down)]], back=1, keys=keys, partitioned=partitioned)
    gaps = may_be_null(bars, ["close"], gaps)
    d = ewm(
        d,
        [
            Ema.span("ema12", "close", 12, gaps=gaps),
            Ema.span("ema26", "close", 26, gaps=gaps),
            Ema.span("_au", "_up", 14, start=1, gaps=gaps),
            Ema.span("_ad", "_down", 14, start=1, gaps=gaps),
        ],
        keys,
        max_block=max_block,
        partitioned=True,
    )
    rsi = rsi_ema_expr(F.col("_au"), F.col("_ad"))
    d = d.withColumn("rsi", rsi)
    signal, conf = rule_expr(F.col("ema12"), F.col("ema26"), F.col("rsi"))
    extra = ["ema12", "ema26", "rsi"] if keep_indicators else []
    return d.select(*keys, TS, "close", *extra, signal.alias("signal"), conf.alias("confidence"), "_i")


def latest_signal(bars: DataFrame, keys=KEYS, max_block=None, gaps: bool | None = None) -> DataFrame:
    """E1 live form: the rule on the last bar of every series (E3 of E2)."""
    return latest_per_series(ema_rsi_backtest(bars, keys, max_block, gaps=gaps).drop("_i"), keys)


def gate_by_confidence(df: DataFrame, threshold: float = 0.3, action: str = "signal", conf: str = "confidence", out: str = "action") -> DataFrame:
    """Keep the action when confidence >= threshold, else NoSignal."""
    return df.withColumn(out, F.when(F.col(conf) >= F.lit(threshold), F.col(action)).otherwise(F.lit(NOSIGNAL)))


def class_to_action(pred: Column) -> Column:
    """Class 1 -> BUY, anything else -> SELL."""
    return F.when(pred == 1, F.lit(BUY)).otherwise(F.lit(SELL))


def model_or_rule(rule: DataFrame, scores: DataFrame, on: Sequence[str], pred: str = "pred", prob: str = "prob") -> DataFrame:
    """E5: per row, the model's action where a model score exists, else the rule's.

    ``scores`` holds (on..., pred, prob) for the series that have a model; it is
    left-joined on ``on``.
    """
    s = scores.select(*on, F.col(pred).alias("_pred"), F.col(prob).alias("_prob"))
    d = rule.join(s, list(on), "left")
    has_model = F.col("_pred").isNotNull()
    return d.select(
        *[c for c in rule.columns if c not in ("signal", "confidence")],
        F.when(has_model, class_to_action(F.col("_pred"))).otherwise(F.col("signal")).alias("signal"),
        F.when(has_model, F.col("_prob")).otherwise(F.col("confidence")).alias("confidence"),
        F.when(has_model, F.lit("model")).otherwise(F.lit("rule")).alias("source"),
    )


def band(conf: Column, high: float = 0.8, low: float = 0.2, two_way: bool = False) -> Column:
    """> high BUY, < low SELL, else HOLD; ``two_way``: >= high BUY, else null."""
    if two_way:
        return F.when(conf >= F.lit(high), F.lit(BUY))
    return F.when(conf > F.lit(high), F.lit(BUY)).when(conf < F.lit(low), F.lit(SELL)).otherwise(F.lit(HOLD))


def high_confidence(p_up: Column, high: float = 0.9, low: float = 0.1) -> tuple[Column, Column]:
    """P(up) > high LONG, < low SHORT, else null; saturation flag.

    Uses P(up) rather than max(P) so both branches can fire.
    """
    side = F.when(p_up > F.lit(high), F.lit("LONG")).when(p_up < F.lit(low), F.lit("SHORT"))
    saturated = ((p_up > F.lit(high)) | (p_up < F.lit(low))).cast("int")
    return side, saturated


def snapshot(scored: DataFrame, features: Sequence[str], keys=KEYS, prob: str = "prob", pred: str = "pred", model: str = "model", n: int = 20) -> DataFrame:
    """Latest row per series with pred, prob, price and the first n features."""
    keys = keys_of(keys)
    cols = [c for c in features][:n]
    base = [*keys, TS, "close", pred, prob]
    last = latest_per_series(scored.select(*base, *[c for c in cols if c not in base]), keys)
    return last.select(
        *keys,
        F.col(TS).alias("row_timestamp"),
        F.col(pred).cast("int").alias("pred"),
        F.col(prob).alias("prob"),
        F.col("close").alias("price"),
        F.lit(model).alias("model"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols],
    )


def position_size(balance: Column, risk: Column, stop: Column) -> Column:
    """Balance x risk / stop distance (null when the stop is 0)."""
    return F.try_divide(balance * risk, stop)
