"""Data quality and leakage checks (G9-G13), all as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.indicators import lag, lead, windowed
from tickweave.operators.series import keys_of
from tickweave.schema import KEYS, TS


def corr_expr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both sides are non-null; null on
    a constant side (Spark's ``corr`` would raise there under ANSI)."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def leakage_correlations(df: DataFrame, features: Sequence[str], keys=KEYS, top: int | None = 30) -> DataFrame:
    """Correlation of every feature with the next close, per series, then
    the ``top`` features by absolute value (nulls last).

    One aggregate computes all correlations (partial aggregation, one row per
    series); ``unpivot`` makes it long; the ranking window runs over the tiny
    (series x feature) table.  A ``future_close`` column from the producer
    (``indicators(..., next_close=True)``) saves the look-ahead shuffle.
    """
    keys = keys_of(keys)
    if "future_close" in df.columns:  # already computed in the producing halo stage
        d = df
    else:
        d = windowed(df, [[("future_close", lead("close", 1, keys))]], fwd=1, keys=keys)
    agg = d.groupBy(*keys).agg(*[corr_expr(F.col(f).cast("double"), F.col("future_close")).alias(f) for f in features])
    long = agg.unpivot(keys, list(features), "feature", "corr")
    if top is None:
        return long
    w = Window.partitionBy(*keys).orderBy(F.abs("corr").desc_nulls_last(), "feature")
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def strict_leakage(df: DataFrame, features: Sequence[str], keys=KEYS, threshold: float = 0.9) -> DataFrame:
    """Features with |corr(feature, next close)| above ``threshold``."""
    return leakage_correlations(df, features, keys, top=None).filter(F.abs("corr") > F.lit(threshold))


def shift_matches(df: DataFrame, features: Sequence[str], keys=KEYS, shifts: Sequence[int] = tuple(k for k in range(-5, 6) if k != 0)) -> DataFrame:
    """(feature, k) where the feature equals close shifted by k on every
    row of the series (nulls equal nulls, like ``Series.equals``).  k < 0 is a
    future close.  One aggregate over all (feature, k) pairs."""
    keys = keys_of(keys)
    back = max([k for k in shifts if k > 0] + [0])
    fwd = max([-k for k in shifts if k < 0] + [0])
    stage = [(f"_sh_{'m' if k < 0 else 'p'}{abs(k)}", lag("close", k, keys) if k > 0 else lead("close", -k, keys)) for k in shifts]
    d = windowed(df, [stage], back=back, fwd=fwd, keys=keys)
    checks = []
    for f in features:
        for k in shifts:
            sh = f"_sh_{'m' if k < 0 else 'p'}{abs(k)}"
            checks.append(F.min(F.col(f).cast("double").eqNullSafe(F.col(sh)).cast("int")).alias(f"{f}|{k}"))
    agg = d.groupBy(*keys).agg(*checks)
    long = agg.unpivot(keys, [f"{f}|{k}" for f in features for k in shifts], "pair", "equal")
    parts = F.split("pair", r"\|")
    return long.filter(F.col("equal") == 1).select(*keys, parts.getItem(0).alias("feature"), parts.getItem(1).cast("int").alias("shift"))


def quality_stats(df: DataFrame, keys=KEYS, exclude: Sequence[str] = ()) -> DataFrame:
    """Per series rows, cols, missing ratio, RSI mean, MACD mean,
    return std.

    ``missing_ratio`` is the mean over data columns of the null (or NaN) share;
    ``cols`` counts the data columns (key columns excluded, since the reference
    keeps the series identity in the file name).  Means are null when the
    column is absent.
    """
    keys = keys_of(keys)
    data_cols = [c for c in df.columns if c not in (*keys, *exclude) and not c.startswith("_")]

    def missing(c):
        dt = df.schema[c].dataType
        m = F.col(c).isNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            m = m | F.isnan(c)
        return F.avg(m.cast("double"))

    miss = [missing(c) for c in data_cols]
    total = miss[0]
    for m in miss[1:]:
        total = total + m

    def mean_of(c, fn=F.avg):
        return fn(c) if c in df.columns else F.lit(None).cast("double")

    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(data_cols)).cast("long").alias("cols"),
        (total / F.lit(float(len(data_cols)))).alias("missing_ratio"),
        mean_of("rsi14").alias("rsi_mean"),
        mean_of("macd").alias("macd_mean"),
        mean_of("return1", F.stddev_samp).alias("return_std"),
    )
