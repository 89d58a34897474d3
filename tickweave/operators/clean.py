"""Cleaning, projection and table-shape operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.core import col_of, from_epoch_us, nan_to_null
from tickweave.operators.series import SEG, fill_backward, fill_forward, keys_of
from tickweave.schema import KEYS, PRICE_COLS, TS


def canonical(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """B1: keep key, time and OHLCV columns in canonical order (pruned at the scan)."""
    return df.select(*[k for k in keys_of(keys) if k in df.columns], ts, *PRICE_COLS)


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B2: fail at plan time when a required column is missing (no data read)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"DataFrame missing required column(s): {missing}")
    return df


def to_utc(df: DataFrame, col: str, fmt: str | None = None, epoch_ms: bool = False, out: str | None = None) -> DataFrame:
    """Parse text / epoch-ms / zone-suffixed text to ``timestamp_ntz`` in UTC.

    Text with an offset (``+00:00``) is parsed as an instant and rendered in
    UTC; naive text is taken as UTC wall-clock time.
    """
    out = out or col
    c = F.col(col)
    if epoch_ms:
        v = F.timestamp_millis(c.cast("long"))
    elif isinstance(df.schema[col].dataType, T.StringType):
        v = F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    else:
        v = c.cast("timestamp")
    # Instant -> UTC wall clock without depending on the session zone.
    return df.withColumn(out, from_epoch_us(F.unix_micros(v.cast("timestamp"))))


def fill_const(df: DataFrame, value: float, cols: Sequence[str] | None = None) -> DataFrame:
    """``fillna(value)``; NaN counts as missing, as in pandas."""
    cols = list(cols or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    return df.select(*[F.coalesce(nan_to_null(c), F.lit(value)).alias(c) if c in cols else F.col(c) for c in df.columns])


def ffill(df: DataFrame, cols: Sequence[str], keys=KEYS) -> DataFrame:
    """B6 forward fill (needs ``_i``)."""
    return fill_forward(df, cols, keys).drop(SEG)


def bfill(df: DataFrame, cols: Sequence[str], keys=KEYS) -> DataFrame:
    """B7 back fill (needs ``_i``)."""
    return fill_backward(df, cols, keys).drop(SEG)


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null (or NaN) in ``cols`` (default all)."""
    cols = list(cols or df.columns)
    cond = None
    for c in cols:
        dt = df.schema[c].dataType
        ok = F.col(c).isNotNull() & ~F.isnan(c) if isinstance(dt, (T.DoubleType, T.FloatType)) else F.col(c).isNotNull()
        cond = ok if cond is None else cond & ok
    return df.filter(cond) if cond is not None else df


def coerce_numeric(df: DataFrame, cols: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """``to_numeric(errors='coerce')`` then fill: ``try_cast`` to double
    (a plain cast raises under ANSI), NaN to null, null to ``fill``."""
    def conv(c):
        v = nan_to_null(F.col(c).try_cast("double"))
        return (F.coalesce(v, F.lit(fill)) if fill is not None else v).alias(c)

    return df.select(*[conv(c) if c in cols else F.col(c) for c in df.columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric column names from the schema (no data scan)."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """``drop(columns=..., errors='ignore')``."""
    return df.drop(*[n for n in names if n in df.columns])


def min_history(df: DataFrame, n: int, keys=KEYS) -> DataFrame:
    """Keep series with at least ``n`` rows.

    Row counts come from a grouped aggregate (partial aggregation, one row per
    series) joined back with a left semi join, so no window holds a series.
    """
    keys = keys_of(keys)
    ok = df.groupBy(*keys).count().filter(F.col("count") >= F.lit(n)).select(*keys)
    return df.join(ok, keys, "left_semi")


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``features`` in order: missing ones as 0.0, extras dropped,
    nulls/NaN to 0.0, everything double.  Idempotent."""
    present = set(df.columns)
    cols = [F.col(k) for k in keep]
    for f in features:
        if f in present:
            cols.append(F.coalesce(nan_to_null(F.col(f).cast("double")), F.lit(0.0)).alias(f))
        else:
            cols.append(F.lit(0.0).alias(f))
    return df.select(*cols)


def threshold_filter(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Rows with ``col >= threshold`` (pushed to the scan when possible)."""
    return df.filter(F.col(col) >= F.lit(threshold))


def rename_to_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Name the time column ``timestamp``."""
    return df.withColumnRenamed(col, TS)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``pd.concat`` by name, missing columns as null, keys kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_series_name(name: Column) -> dict[str, Column]:
    """A3: ``<PAIR>__<tf>__<yyyymmdd_HHMMSS>[__chunkN].csv`` to its parts."""
    base = F.regexp_replace(name, r"\.[A-Za-z]+$", "")
    parts = F.split(base, "__")
    return {
        "pair": F.element_at(parts, 1),
        "timeframe": F.element_at(parts, 2),
        "run_time": F.regexp_replace(F.element_at(parts, 3), r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6").try_cast("timestamp_ntz"),
        "chunk": F.regexp_extract(name, r"__chunk(\d+)", 1).try_cast("int"),
    }


def series_file_name(pair: Column, timeframe: Column, run_time: Column, chunk: Column | None = None) -> Column:
    """Writer side of A3 (the reference's file naming)."""
    base = F.format_string("%s__%s__%s", pair, timeframe, F.date_format(run_time, "yyyyMMdd_HHmmss"))
    if chunk is not None:
        base = F.when(chunk.isNull(), base).otherwise(F.concat(base, F.lit("__chunk"), chunk.cast("string")))
    return F.concat(base, F.lit(".csv"))


def manifest(df: DataFrame, source: str = "source", ts: str = TS) -> DataFrame:
    """Rows and first time per source (one partial aggregate)."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"))


def coverage(present: DataFrame, timeframes: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Expected (symbol, timeframe) series that have no data.

    Expected = every distinct symbol with each name of the fixed timeframe
    list (an explode of a literal array, linear in symbols, no cross join);
    missing = left anti join against the series present.
    """
    sym, tf = keys_of(keys)
    symbols = present.select(sym).distinct()
    expected = symbols.select(sym, F.explode(F.array(*[F.lit(t) for t in timeframes])).alias(tf))
    have = present.select(sym, tf).distinct()
    return expected.join(have, [sym, tf], "left_anti")


def as_double(c) -> Column:
    return col_of(c).cast("double")
