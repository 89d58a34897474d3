"""Labels and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.core import safe_div
from tickweave.operators.clean import numeric_columns
from tickweave.operators.indicators import lead, windowed, zscore
from tickweave.operators.series import IDX, keys_of
from tickweave.schema import KEYS, LABEL_SETTINGS, TS


def next_bar_up(df: DataFrame, keys=KEYS, out: str = "target", last_row: str = "drop") -> DataFrame:
    """1 if the next close is higher, else 0.

    ``last_row='zero'`` matches the reference (the last row of each series
    compares with a missing value and gets 0); ``'drop'`` removes it.  An
    existing ``target`` column is kept as it is.
    """
    if out in df.columns:
        return df
    d = windowed(df, [[("_next_close", lead("close", 1, keys))]], fwd=1, keys=keys)
    up = (F.col("_next_close") > F.col("close")).cast("int")
    if last_row == "zero":
        return d.withColumn(out, F.coalesce(up, F.lit(0))).drop("_next_close")
    return d.filter(F.col("_next_close").isNotNull()).withColumn(out, up).drop("_next_close")


def future_return(df: DataFrame, horizon: int = 5, keys=KEYS, out: str = "future_return") -> DataFrame:
    """``close(t+h) / close(t) - 1`` (null for the last h rows)."""
    return windowed(df, [[(out, safe_div(lead("close", horizon, keys), F.col("close")) - F.lit(1.0))]], fwd=horizon, keys=keys)


def binary_target(df: DataFrame, horizon: int = 5, threshold: float = 0.0, keys=KEYS, normalise: bool = True) -> DataFrame:
    """D3: future return over ``horizon`` bars > ``threshold``; numeric columns
    z-scored per series with statistics of the whole series (tail included,
    as in the reference); then rows with any null dropped (the tail)."""
    keys = keys_of(keys)
    d = future_return(df, horizon, keys)
    d = d.withColumn("target", F.coalesce((F.col("future_return") > F.lit(threshold)).cast("int"), F.lit(0)))
    if normalise:
        cols = numeric_columns(d, exclude=("target", "future_return", IDX, *keys))
        d = zscore(d, cols, keys)
    return d.na.drop()


def ternary_label(df: DataFrame, keys=KEYS, settings: dict | None = None, default: str = "1h", keep_future: bool = False, partitioned: bool = False) -> DataFrame:
    """Label -1/0/1 from the future return over a horizon and threshold
    that depend on the timeframe (exact match on the ``timeframe`` column, so
    15m gets its own settings); a timeframe without settings takes those of
    ``default``.  Rows without a future bar keep label 0.

    The horizon differs per row, so one ``lead`` is computed for each distinct
    horizon (a handful) and the right one picked with ``when``.
    """
    settings = settings or LABEL_SETTINGS
    horizons = sorted({h for h, _ in settings.values()})
    tf = F.col("timeframe")
    stage = [(f"_lead_{h}", lead("close", h, keys)) for h in horizons]
    d = windowed(df, [stage], fwd=max(horizons), keys=keys, partitioned=partitioned)
    fut: Column | None = None
    thr: Column | None = None
    for name, (h, t) in settings.items():
        fr = safe_div(F.col(f"_lead_{h}"), F.col("close")) - F.lit(1.0)
        fut = F.when(tf == name, fr) if fut is None else fut.when(tf == name, fr)
        thr = F.when(tf == name, F.lit(t)) if thr is None else thr.when(tf == name, F.lit(t))
    h, t = settings[default]
    fut = fut.otherwise(safe_div(F.col(f"_lead_{h}"), F.col("close")) - F.lit(1.0))
    d = d.withColumn("future_return", fut).withColumn("_thr", thr.otherwise(F.lit(t)))
    label = (
        F.when(F.col("future_return") > F.col("_thr"), F.lit(1))
        .when(F.col("future_return") < -F.col("_thr"), F.lit(-1))
        .otherwise(F.lit(0))
    )
    d = d.withColumn("label", label).drop("_thr", *[f"_lead_{h}" for h in horizons])
    return d if keep_future else d.drop("future_return")


def encode_labels(df: DataFrame, label: str = "label", out: str = "label_idx") -> DataFrame:
    """Classes to 0..k-1 in sorted order (numeric order for numbers).

    The global ``dense_rank`` runs over the class table (one row per class);
    whether that table is broadcast is left to its measured size.
    """
    classes = df.select(label).distinct().filter(F.col(label).isNotNull())
    classes = classes.withColumn(out, (F.dense_rank().over(Window.orderBy(label)) - 1).cast("int"))
    return df.join(classes, label, "left")


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weight ``n / (k * n_class)`` per row (feeds ``weightCol``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k")).withColumn("_all", F.lit(0))
    counts = counts.withColumn("_all", F.lit(0)).join(total, "_all")
    return df.join(counts.select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out)), label, "left")
