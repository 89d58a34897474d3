"""Exponential moving averages as a blocked linear scan (pure DataFrame).

Recursion (pandas ``ewm(adjust=False)``): ``y_s = x_s`` at the seed row,
``y_t = lam * y_{t-1} + a * x_t`` after it, ``lam = 1 - a``.

Spark has no window function for a recursion, so it is unrolled in blocks of ``B``
rows (``j`` = the row's place in its block): inside a block a prefix sum,
``loc_j = lam^j * sum_{s<=j} w_s x_s lam^-s``; the block as a whole is a pair
(decay ``lam^B``, value ``t``) that turns the average ``c`` before it into
``lam^B c + t``; pairs join into pairs, so the averages before all blocks come from
the multi-level scan (``scan``), and ``y = loc_j + lam^(j+1) c``.  ``B`` keeps
``lam^-j`` inside the double range (``lam^-B <= 1e250``) and is a power of two that
divides the segment.  Nothing is cut off: the result equals the plain recursion to
rounding, tiny values included.

Inputs with nulls (``gaps``): a null row keeps the average, and the first value
after ``d - 1`` null rows is weighed ``a`` against ``lam^d`` for the old average, both
divided by their sum, as pandas does.  Inside a block the average is then
``p_j y_f + l_j`` in terms of the average ``y_f`` at the block's first value; the
block's element (place and size of its first value, ``p`` and ``l`` at its end, place of
its last value) again joins with its follower's into one of the same kind.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.core import col_of
from tickweave.operators.scan import Carry, number, quoted, struct
from tickweave.operators.series import SEGMENT_ROWS
from tickweave.schema import KEYS


@dataclass(frozen=True)
class Ema:
    """One EMA: output column, input column/expression, smoothing factor."""

    out: str
    x: object
    alpha: float
    start: int = 0  # seed row index; rows before it give null
    gaps: bool = False  # the input may hold nulls from ``start`` on
    place: object = None  # with gaps: the row number that distances are taken from, if not the row index

    @staticmethod
    def span(out: str, x, span: float, start: int = 0, gaps: bool = False) -> "Ema":
        return Ema(out, x, 2.0 / (span + 1.0), start, gaps)

    @staticmethod
    def com(out: str, x, period: float, start: int = 0, gaps: bool = False) -> "Ema":
        """Wilder smoothing, ``alpha = 1/period``."""
        return Ema(out, x, 1.0 / period, start, gaps)


@dataclass(frozen=True)
class EmaOfEmas:
    """An EMA of ``sum(coef * ema)`` over EMAs computed in the same carry
    stage (the MACD signal: ``{"ema12": 1, "ema26": -1}``, span 9), solved
    without a second shuffle.  Seeded on row 0; inputs without gaps."""

    out: str
    terms: dict
    alpha: float

    @staticmethod
    def span(out: str, terms: dict, span: float) -> "EmaOfEmas":
        return EmaOfEmas(out, dict(terms), 2.0 / (span + 1.0))


def block_rows(alpha: float, seg_rows: int = SEGMENT_ROWS, limit: int | None = None) -> int:
    """Largest power of two <= the double-range bound that divides the segment."""
    lam = 1.0 - alpha
    if lam <= 0.0:
        return seg_rows
    bound = int(250.0 / -math.log10(lam))
    if limit:
        bound = min(bound, limit)
    b = 1
    while b * 2 <= min(bound, seg_rows):
        b *= 2
    if seg_rows % b:
        raise ValueError("segment rows must be a power of two")
    return b


def power(base: float, e: Column) -> Column:
    return F.pow(F.lit(base), e.cast("double"))


def plain_carry(name: str, t: Column, lam: float, rows: int) -> Carry:
    """The average at the end of the previous block, from block-end values ``t``."""
    return Carry(
        name,
        [(name, t)],
        lambda e: struct(t=f"{e}.{quoted(name)}", d=number(lam**rows)),
        lambda a, b: struct(t=f"{a}.t * {b}.d + {b}.t", d=f"{a}.d * {b}.d"),
        struct(t="0.0D", d="1.0D"),
        lambda s, t: f"{s} * {t}.d + {t}.t",
        "0.0D",
    )


def combined_carry(name: str, inner: list[tuple[float, float, Column, Column, Column]], mu: float, rows: int) -> Carry:
    """State of an EMA (factor ``mu``) of ``sum_k a_k y_k``: (its average, the averages y_k), at
    the end of the previous block.

    ``inner``: (a_k, lam_k, block-end value of y_k, u_k, v_k) with u and v as in ``carry._combo``:
    the block-end value of the outer average is ``sum_k a_k (u_k + v_k c_k)`` for averages
    ``c_k`` before the block.  Over a run of blocks everything stays linear in the states before
    it: ``o`` without any, ``s_k`` per unit of ``c_k``, ``do`` per unit of the outer average.
    """
    ks = range(len(inner))
    field = lambda e, f, k: f"{e}.{quoted(f'{name}_{f}{k}')}"
    fields = [(f"{name}_{f}{k}", c) for k in ks for f, c in zip("tuv", inner[k][2:])]

    def made(o: str, do: str, per: list[tuple[str, str, str]]) -> str:
        return struct(o=o, do=do, **{f"{f}{k}": x for k in ks for f, x in zip("tds", per[k])})

    def total(e: str) -> str:
        o = " + ".join(f"{number(inner[k][0])} * {field(e, 'u', k)}" for k in ks)
        return made(o, number(mu**rows), [(field(e, "t", k), number(inner[k][1] ** rows), f"{number(inner[k][0])} * {field(e, 'v', k)}") for k in ks])

    def join(a: str, b: str) -> str:
        o = " + ".join([f"{a}.o * {b}.do + {b}.o", *(f"{b}.s{k} * {a}.t{k}" for k in ks)])
        return made(o, f"{a}.do * {b}.do", [(f"{a}.t{k} * {b}.d{k} + {b}.t{k}", f"{a}.d{k} * {b}.d{k}", f"{a}.s{k} * {b}.do + {b}.s{k} * {a}.d{k}") for k in ks])

    def step(s: str, t: str) -> str:
        o = " + ".join([f"{s}.o * {t}.do + {t}.o", *(f"{t}.s{k} * {s}.c{k}" for k in ks)])
        return struct(o=o, **{f"c{k}": f"{s}.c{k} * {t}.d{k} + {t}.t{k}" for k in ks})

    return Carry(name, fields, total, join, made("0.0D", "1.0D", [("0.0D", "1.0D", "0.0D") for _ in ks]), step, struct(o="0.0D", **{f"c{k}": "0.0D" for k in ks}))


def gap_carry(name: str, s: Ema, first: Column, x_first: Column, p: Column, y: Column, last: Column) -> Carry:
    """State (average, place of the last value) at the end of the previous block."""
    names = [f"{name}_{f}" for f in "fxple"]
    a = number(s.alpha)

    def join(one: str, two: str) -> str:
        w = f"pow({number(1.0 - s.alpha)}, cast({two}.f - {one}.e as double))"
        p = f"{two}.p * ({w} / ({w} + {a})) * {one}.p"
        y = f"{two}.p * (({w} * {one}.l + {a} * {two}.x) / ({w} + {a})) + {two}.l"
        return f"CASE WHEN {two}.f IS NULL THEN {one} WHEN {one}.f IS NULL THEN {two} ELSE {struct(f=f'{one}.f', x=f'{one}.x', p=p, l=y, e=f'{two}.e')} END"

    def step(state: str, t: str) -> str:
        return f"CASE WHEN {t}.f IS NULL THEN {state} ELSE {struct(c=f'{t}.p * ({gap_first(s, state, f"{t}.f", f"{t}.x")}) + {t}.l', at=f'{t}.e')} END"

    d, i = "cast(null as double)", "cast(null as bigint)"
    element = lambda e: struct(**{f: f"{e}.{quoted(n)}" for f, n in zip("fxple", names)})
    return Carry(name, list(zip(names, (first, x_first, p, y, last))), element, join, struct(f=i, x=d, p=d, l=d, e=i), step, struct(c=d, at=i))


def gap_first(s: Ema, state: str, place: str, x: str) -> str:
    """The average at a block's first value ``x``, from the state before the block (SQL text)."""
    w = f"pow({number(1.0 - s.alpha)}, cast({place} - {state}.at as double))"
    a = number(s.alpha)
    return f"CASE WHEN {state}.at IS NULL THEN {x} ELSE ({w} * {state}.c + {a} * {x}) / ({w} + {a}) END"


def ewm(
    df: DataFrame,
    specs: Sequence[Ema],
    keys=KEYS,
    seg_rows: int | None = None,
    max_block: int | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """Add one column per spec in one carry stage.  ``df`` needs the dense ``_i``."""
    from tickweave.operators.carry import carry_stage

    return carry_stage(df, keys, seg_rows, emas=list(specs), max_block=max_block, partitioned=partitioned)


def ewm_gaps(df: DataFrame, specs: Sequence[Ema], keys=KEYS, seg_rows: int | None = None, max_block: int | None = None, partitioned: bool = False) -> DataFrame:
    """``ewm`` for inputs with nulls, as pandas ``ewm(adjust=False)`` weighs them."""
    return ewm(df, [Ema(s.out, s.x, s.alpha, s.start, True) for s in specs], keys, seg_rows, max_block, partitioned)


def may_be_null(df: DataFrame, columns: Sequence[str], gaps: bool | None) -> bool:
    """``gaps`` as given, or, if None, whether the schema lets any of ``columns`` be null."""
    return any(df.schema[c].nullable for c in columns) if gaps is None else gaps
