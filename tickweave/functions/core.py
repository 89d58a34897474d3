"""Scalar helpers shared by the operators.

All helpers return plain ``Column`` expressions built from Spark built-ins,
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.schema import TIMEFRAMES

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970-01-01 for a timestamp column of either kind.

    ``timestamp_ntz`` is read as wall-clock UTC without touching the session
    zone; ``timestamp`` uses its instant.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(name))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.col(name).cast("long")
    raise TypeError(f"{name} is {dtype}, expected a timestamp")


def from_epoch_us(c) -> Column:
    """Inverse of :func:`epoch_us`, returning ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", col_of(c), F.expr(_EPOCH_NTZ))


def tf_seconds(c="timeframe") -> Column:
    """Bar length in seconds for a timeframe name column (null if unknown)."""
    expr = None
    for name, secs in TIMEFRAMES.items():
        cond = col_of(c) == F.lit(name)
        expr = F.when(cond, F.lit(secs)) if expr is None else expr.when(cond, F.lit(secs))
    return expr.otherwise(F.lit(None)).cast("long")


def safe_div(n, d) -> Column:
    """Division that yields null on a zero or null divisor (ANSI-safe)."""
    return F.try_divide(col_of(n), col_of(d))


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; Spark keeps them apart.  Map NaN to null."""
    return F.nanvl(col_of(c), F.lit(None).cast("double"))


def rounded(c, digits: int = 6) -> Column:
    """Round for value comparison and clear negative zero."""
    return F.round(col_of(c).cast("double"), digits) + F.lit(0.0)


def to_utc_timestamp_col(c) -> Column:
    """``timestamp_ntz`` (wall clock in UTC) to ``timestamp`` (instant)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col_of(c)))
