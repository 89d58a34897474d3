"""A multi-level scan over the segments of series: state carried across any number of rows.

Something carried along a series (a running sum, the last value, an average) is a
``Carry``: every block of rows has a *total*, totals of neighbouring runs join into
one, and a total turns the *state* before its rows into the state after them.  With
that, no task ever walks a series:

1. a block's total is a plain aggregate of its rows, a segment's the join of its blocks;
2. ``FAN`` neighbouring segments form a super-segment, one row with its segments in an
   array; its total is the join of theirs;
3. the states before the super-segments of a series come from the totals before
   them (at most ``FAN`` rows a series: longer series are refused with a message that
   says to raise the segment size);
4. each super-segment hands the states down to its segments, and a segment to its blocks.

The tables of steps 2 and 3 have one row per segment and per super-segment; each is
shuffled once, whatever the segment size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 4096  # segments of a super-segment, and super-segments of a series


@dataclass(frozen=True)
class Carry:
    """One carried quantity.  ``fields`` are aggregates over a block's rows (name, column).
    The others are SQL text or make SQL text from it (a scan has hundreds of small
    expressions, and text is built without calls into the JVM): ``total`` makes a block's
    total from the struct of all fields, ``join`` the total of a run and its follower,
    ``step`` the state after a total; ``none`` is the total of no rows, ``start`` the state
    before the first row.  ``backward``: carried from the end of the series; ``join`` and
    ``step`` then meet rows from last to first."""

    name: str
    fields: list[tuple[str, Column]]
    total: Callable[[str], str]
    join: Callable[[str, str], str]
    none: str
    step: Callable[[str, str], str]
    start: str
    backward: bool = False


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number(x: float) -> str:
    return f"{x!r}D"


def struct(**parts: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {x}" for n, x in parts.items()) + ")"


def running(name: str, term: Column) -> Carry:
    """The sum of all earlier terms."""
    add = lambda a, b: f"({a} + {b})"
    return Carry(name, [(name, F.coalesce(F.sum(term).cast("double"), F.lit(0.0)))], lambda e: f"{e}.{quoted(name)}", add, "0.0D", add, "0.0D")


def latest(name: str, value: Column, position: Column, dtype: str, backward: bool = False) -> Carry:
    """The last value before the block that is not null (``backward``: the first behind it)."""
    none = f"cast(null as {dtype})"
    newer = lambda a, b: f"coalesce({b}, {a})"
    pick = F.min_by if backward else F.max_by
    return Carry(name, [(name, pick(value, F.when(value.isNotNull(), position)))], lambda e: f"{e}.{quoted(name)}", newer, none, newer, none, backward)


def _ordered(c: Carry, rows: str) -> str:
    return f"reverse({rows})" if c.backward else rows


def _total(c: Carry, rows: str, of: Callable[[str], str]) -> str:
    return f"aggregate({_ordered(c, rows)}, {c.none}, (acc, e) -> {c.join('acc', of('e'))})"


def _states(c: Carry, start: str, rows: str, of: Callable[[str], str]) -> str:
    """The states before the elements of ``rows`` (behind them, if backward), in their order."""
    first = struct(s=start, a=f"slice(array({start}), 1, 0)")
    step = struct(s=c.step("acc.s", of("e")), a="concat(acc.a, array(acc.s))")
    return _ordered(c, f"aggregate({_ordered(c, rows)}, {first}, (acc, e) -> {step}, acc -> acc.a)")


def segment_states(rows: DataFrame, keys: Sequence[str], seg: str, block: str | None, per_seg: int, carries: Sequence[Carry]) -> DataFrame:
    """``keys, seg, one column per carry``: the state before each segment, or, with a ``block``
    column (``per_seg`` blocks a segment), the array of states before each of its blocks.

    ``rows`` should be hash partitioned on (keys, seg); then the totals need no shuffle of
    it.  Blocks must be numbered without holes (a dense row index).
    """
    keys = list(keys)
    keys_sql = [quoted(k) for k in keys]
    fields = [f.alias(n) for c in carries for n, f in c.fields]
    names = [n for c in carries for n, _ in c.fields]
    if block is None:
        segs = rows.groupBy(*keys, seg).agg(*fields).select(*keys, seg, F.array(F.struct(*names)).alias("_blocks"))
    else:
        blocks = rows.groupBy(*keys, seg, block).agg(*fields)
        segs = blocks.groupBy(*keys, seg).agg(F.sort_array(F.collect_list(F.struct(block, *names))).alias("_blocks"))
        first, last = F.element_at("_blocks", 1)[block], F.element_at("_blocks", -1)[block]
        holes = (first != F.col(seg) * per_seg) | (last - first + 1 != F.size("_blocks"))
        segs = segs.withColumn("_blocks", F.when(holes, F.raise_error(F.lit("the row index has holes; number the rows again with index_rows"))).otherwise(F.col("_blocks")))
    long = F.raise_error(F.lit(f"a series has more than {FAN} x {FAN} segments; raise spark.tickweave.segmentRows"))
    sup = F.when(F.col(seg) >= FAN * FAN, long.cast("long")).otherwise(F.floor(F.col(seg) / FAN).cast("long"))
    own = {c.name: quoted(c.name) for c in carries}
    totals = struct(**{n: _total(c, "_blocks", c.total) for n, c in zip(own, carries)})
    supers = segs.select(*keys, seg, sup.alias("_sup"), F.expr(totals).alias("_tot"), "_blocks").groupBy(*keys, "_sup").agg(F.sort_array(F.collect_list(F.struct(seg, "_tot", "_blocks"))).alias("_segs"))
    totals = struct(**{n: _total(c, "_segs", lambda e, n=n: f"{e}._tot.{own[n]}") for n, c in zip(own, carries)})
    supers = supers.select("*", F.expr(totals).alias("_stot"))
    series = Window.partitionBy(*keys)  # at most FAN rows
    past = {False: series.orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1), True: series.orderBy(F.desc("_sup")).rowsBetween(Window.unboundedPreceding, -1)}
    supers = supers.select("*", *[F.collect_list("_stot").over(past[b]).alias(f"_past{int(b)}") for b in sorted({c.backward for c in carries})])
    supers = supers.selectExpr(*keys_sql, "_segs", *[f"aggregate(_past{int(c.backward)}, {c.start}, (acc, e) -> {c.step('acc', f'e.{own[c.name]}')}) AS {own[c.name]}" for c in carries])
    states = [f"{_states(c, own[c.name], '_segs', lambda e, n=c.name: f'{e}._tot.{own[n]}')} AS {own[c.name]}" for c in carries]
    out = supers.selectExpr(*keys_sql, "_segs", *states).selectExpr(*keys_sql, f"inline(arrays_zip(_segs, {', '.join(own.values())}))")
    if block is None:
        return out.selectExpr(*keys_sql, f"_segs.{quoted(seg)} AS {quoted(seg)}", *own.values())
    return out.selectExpr(*keys_sql, f"_segs.{quoted(seg)} AS {quoted(seg)}", *[f"{_states(c, own[c.name], '_segs._blocks', c.total)} AS {own[c.name]}" for c in carries])


def offsets(counts: DataFrame, keys: Sequence[str], place: str, n: str, out: str) -> DataFrame:
    """``counts`` (one row per series and place) with the sum of ``n`` over all smaller places of
    the series.  Places are summed in groups of ``FAN``; a series has one row per group
    that holds rows, so only a long span of places makes many of them."""
    keys = list(keys)
    zero, add = "cast(0 as bigint)", lambda a, b: f"({a} + {b})"
    c = Carry(out, [], lambda e: f"{e}.{quoted(n)}", add, zero, add, zero)
    groups = counts.groupBy(*keys, F.floor(F.col(place) / FAN).alias("_sup")).agg(F.sort_array(F.collect_list(F.struct(place, n))).alias("_rows"), F.sum(n).alias("_all"))
    before = Window.partitionBy(*keys).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*keys, "_rows", F.coalesce(F.sum("_all").over(before), F.lit(0)).cast("long").alias("_in"))
    groups = groups.select(*keys, "_rows", F.expr(_states(c, "_in", "_rows", c.total)).alias("_st"))
    rows = groups.select(*keys, F.inline(F.arrays_zip("_rows", "_st")))
    return rows.select(*keys, F.col("_rows")[place].alias(place), F.col("_st").alias(out))
