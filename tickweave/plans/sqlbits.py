"""DuckDB SQL fragments for the oracle texts (independent of the Spark code).

The EMA oracle is the plain recursion over the whole prefix list
(``list_reduce``), quadratic but exact and unrelated to the blocked scan.
Constants are cast to DOUBLE because DuckDB literals are DECIMAL.
"""

from __future__ import annotations

SERIES = "PARTITION BY symbol, timeframe"
ORDER = f"{SERIES} ORDER BY timestamp"


def frame(n: int | None = None, fwd: bool = False) -> str:
    if n is None:
        return f"({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"({ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def ema(x: str, alpha: float, skip_nulls: bool = False) -> str:
    lst = f"list({x}) OVER {frame()}"
    if skip_nulls:
        lst = f"list_filter({lst}, lambda v: v IS NOT NULL)"
    return f"list_reduce({lst}, lambda a, v: a * {d(1.0 - alpha)} + v * {d(alpha)})"


def ema_span(x: str, span: float, skip_nulls: bool = False) -> str:
    return ema(x, 2.0 / (span + 1.0), skip_nulls)


def lag(x: str, k: int = 1) -> str:
    return f"lag({x}, {k}) OVER ({ORDER})"


def lead(x: str, k: int = 1) -> str:
    return f"lead({x}, {k}) OVER ({ORDER})"


def rolling(agg: str, x: str, n: int, min_periods: int | None = None) -> str:
    m = n if min_periods is None else min_periods
    return f"CASE WHEN count({x}) OVER {frame(n)} >= {m} THEN {agg}({x}) OVER {frame(n)} END"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def r(x: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0.0 AS {name}"


def ema_gaps(x: str, alpha: float) -> str:
    """Plain recursion with pandas' weights over nulls: state (value, weight of the old value)."""
    lam, a = d(1.0 - alpha), d(alpha)
    step = (
        "lambda s, e: CASE WHEN e.v IS NULL THEN {'v': s.v, 'w': s.w * " + lam + "} WHEN s.v IS NULL THEN e "
        "ELSE {'v': (s.w * " + lam + " * s.v + " + a + " * e.v) / (s.w * " + lam + " + " + a + "), 'w': CAST(1.0 AS DOUBLE)} END"
    )
    return f"list_reduce(list({{'v': CAST({x} AS DOUBLE), 'w': CAST(1.0 AS DOUBLE)}}) OVER {frame()}, {step}).v"
