"""Bars: resample ticks/bars (A15), keep-first de-dup (B4), grid (B5), latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.core import epoch_us, from_epoch_us, tf_seconds
from tickweave.operators.series import IDX, index_rows, keys_of, segment_rows
from tickweave.schema import KEYS, PRICE_COLS, TIMEFRAMES, TS


def _step_us(timeframe: str) -> int:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}; known: {sorted(TIMEFRAMES)}")
    return TIMEFRAMES[timeframe] * 1_000_000


def ticks_to_bars(
    ticks: DataFrame,
    timeframe: str,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    volume: str | None = None,
    tiebreak: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """trades/ticks to OHLCV bars of one timeframe.

    Without ``tiebreak`` or ``order``, ticks of equal time are ordered by
    price (so open is the lowest and close the highest of them): the result
    never depends on task order.

    ``groupBy(symbol, bucket)`` with partial aggregation, so a hot symbol is
    combined map-side before the shuffle.  Open/close are the first/last price
    by time (``tiebreak`` orders equal times); volume is the summed size, or the
    tick count when no volume column is given.  ``order`` replaces the
    (time, tiebreak) ordering by one numeric column that sorts the same way
    inside a bucket; an atomic ordering keeps the aggregate hash-based (a
    struct ordering makes Spark sort).
    """
    step = _step_us(timeframe)
    if order is not None:
        order = F.col(order)
    else:
        order = F.struct(F.col(ts), F.col(tiebreak or price))
    bucket = from_epoch_us(F.floor(epoch_us(ticks, ts) / F.lit(step)) * F.lit(step))
    vol = F.sum(F.col(volume).cast("double")) if volume else F.count(F.lit(1)).cast("double")
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), bucket.alias(TS))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            vol.alias("volume"),
        )
        .select("symbol", F.lit(timeframe).alias("timeframe"), TS, *PRICE_COLS)
    )


def resample_bars(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("symbol",), ts: str = TS) -> DataFrame:
    """Finer bars to coarser bars (e.g. 1m to 1h), partial aggregation."""
    step = _step_us(timeframe)
    keys = [k for k in keys_of(keys) if k != "timeframe"]
    bucket = from_epoch_us(F.floor(epoch_us(bars, ts) / F.lit(step)) * F.lit(step))
    return (
        bars.groupBy(*keys, bucket.alias(TS))
        .agg(
            F.min_by("open", ts).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", ts).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select(*keys, F.lit(timeframe).alias("timeframe"), TS, *PRICE_COLS)
    )


def dedup_keep_first(df: DataFrame, order: Sequence[str], keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """One row per (series, timestamp), keeping the first by ``order``.

    ``order`` is the source order, e.g. ``(source_file, row_in_file)``; plain
    ``dropDuplicates`` would keep an arbitrary row.  The window partition is one
    (series, timestamp), so it is tiny whatever the series size.
    """
    keys = keys_of(keys)
    w = Window.partitionBy(*keys, ts).orderBy(*[F.col(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


FREE_SLOTS = 1_000_000  # grids up to this size are never refused


def chunk_table(spans: DataFrame, n: str, chunk_rows: int, out: str = "_c", fan: int = 1024) -> DataFrame:
    """One row per chunk of ``chunk_rows`` grid slots (0 .. ``n``) of every row of ``spans``.

    Ranges are halved into chunks level by level, ``fan`` parts at a time, and dealt out anew
    between the levels: no row holds an array longer than ``fan`` (a series of up to
    ``fan``^3 chunks), and the chunks of one series come from many tasks.
    """
    last = F.floor(F.col(n) / F.lit(chunk_rows)).cast("long")
    d = spans.withColumn("_last", F.when(last < fan**3, last).otherwise(F.raise_error(F.lit(f"a series has more than {fan}^3 chunks of {chunk_rows} slots")).cast("long")))
    keep = [c for c in spans.columns if c != out]
    d = d.withColumn(out, F.lit(0).cast("long"))
    for size in (fan * fan, fan, 1):
        first = F.col(out) * fan
        many = F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / size)) if size == fan * fan else F.sequence(first, F.least(first + (fan - 1), F.floor(F.col("_last") / size)))
        d = d.select(*keep, "_last", F.explode(many).alias(out))
        if size == fan:  # one row per ``fan`` chunks; a stated number of partitions, as these few rows become many
            d = d.repartition(int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[c for c in keep if not c.startswith("_")], out)
    return d.drop("_last")


def regularise(
    bars: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    value_cols: Sequence[str] | None = None,
    chunk_rows: int | None = None,
    fill: str | None = None,
    slots_per_bar: int = 10_000,
) -> DataFrame:
    """Pandas ``asfreq`` per series: a full grid from the first bar on.

    The grid starts at the series' first timestamp and steps by the
    timeframe's length up to the last bar; bars off the grid are dropped and
    missing slots get null values.  Adds the dense row index ``_i`` (the grid
    position), so later window work needs no numbering pass.
    ``fill='ffill_bfill'`` (the reference's ``asfreq().ffill().bfill()``) or
    ``'ffill'`` fills the gaps in the same pass.

    Two things are refused with a message instead of giving a grid that means nothing:
    two bars of one series at the same time (``dedup_keep_first`` keeps the first), and a
    series whose grid has over ``slots_per_bar`` slots for each of its bars, and over a
    million in all - a stray time long before or after the others.

    Plan: the span per series is a one-row-per-series aggregate; bars get
    their grid position from it (a join AQE broadcasts when small, and
    splits when skewed).  The grid is generated level by level (``chunk_table``),
    so a long series is spread over many tasks and no row holds more than 1,024 places.
    Grid rows and bar rows are unioned and shuffled once by
    ``(keys, _seg)`` and merged per grid slot; the output stays partitioned
    that way, so the fill and the next window stage reuse the shuffle.
    A series whose timeframe has no known length has no grid: its bars are
    returned as they are (not filled), numbered by time.
    """
    from tickweave.operators.carry import carry_stage
    from tickweave.operators.series import SEG

    keys = keys_of(keys)
    seg_rows = segment_rows(bars)
    chunk_rows = chunk_rows or seg_rows
    value_cols = list(value_cols or [c for c in bars.columns if c not in (*keys, ts, IDX, SEG)])
    if "timeframe" not in bars.columns:
        raise ValueError("regularise needs a timeframe column")
    t = epoch_us(bars, ts)
    gridless = bars.filter(tf_seconds("timeframe").isNull()).select(*keys, ts, *value_cols)
    bars = bars.filter(tf_seconds("timeframe").isNotNull())
    b = bars.select(*keys, t.alias("_t"), *value_cols, (tf_seconds("timeframe") * F.lit(1_000_000)).alias("_step"))
    span = b.groupBy(*keys).agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"), F.first("_step").alias("_step"), F.count(F.lit(1)).alias("_bars"))
    slots = F.floor((F.col("_t1") - F.col("_t0")) / F.col("_step")).cast("long")
    stray = F.raise_error(F.concat(F.lit("regularise: the grid of "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(" has "), slots.cast("string"),
                                   F.lit(" slots for "), F.col("_bars").cast("string"), F.lit(" bars; drop the stray time or raise slots_per_bar")))
    span = span.withColumn("_n", F.when((slots > FREE_SLOTS) & (slots > F.col("_bars") * slots_per_bar), stray.cast("long")).otherwise(slots))
    placed = b.drop("_step").join(span.select(*keys, "_t0", "_step"), keys)
    off = F.col("_t") - F.col("_t0")
    placed = placed.filter(off % F.col("_step") == 0).select(
        *keys, (off / F.col("_step")).cast("long").alias(IDX), "_t0", "_step", F.lit(1).alias("_bar"), *value_cols
    )
    chunks = chunk_table(span.select(*keys, "_t0", "_step", "_n"), "_n", chunk_rows)
    first = F.col("_c") * F.lit(chunk_rows)
    grid = chunks.select(*keys, "_t0", "_step", F.explode(F.sequence(first, F.least(first + F.lit(chunk_rows - 1), F.col("_n")))).alias(IDX))
    types = dict(bars.dtypes)
    grid = grid.select(*keys, IDX, "_t0", "_step", F.lit(0).alias("_bar"), *[F.lit(None).cast(types[c]).alias(c) for c in value_cols])
    u = grid.unionByName(placed).withColumn(SEG, F.floor(F.col(IDX) / F.lit(seg_rows)).cast("long"))
    u = u.repartition(*keys, SEG)
    g = u.groupBy(*keys, SEG, IDX).agg(
        F.max("_t0").alias("_t0"), F.max("_step").alias("_step"), F.sum("_bar").alias("_bar"), *[F.max(c).alias(c) for c in value_cols]  # one bar at most
    )
    twice = F.raise_error(F.concat(F.lit("regularise: "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(" has several bars at one time; use dedup_keep_first")))
    g = g.withColumn("_t0", F.when(F.col("_bar") > 1, twice.cast("long")).otherwise(F.col("_t0")))
    out = g.select(*keys, from_epoch_us(F.col("_t0") + F.col(IDX) * F.col("_step")).alias(ts), *value_cols, IDX, SEG)
    if fill == "ffill_bfill":
        out = carry_stage(out, keys, fill_chain=value_cols, fill_value=None, partitioned=True)
    elif fill == "ffill":
        out = carry_stage(out, keys, ffill=value_cols, partitioned=True)
    # A constant known timeframe makes this branch empty at planning time.
    return out.drop(SEG).select(*keys, ts, *value_cols, IDX).unionByName(index_rows(gridless, keys, ts).select(*keys, ts, *value_cols, IDX))


def latest_per_series(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Last row of each series, as one aggregate (partial agg, no sort).

    ``max_by(struct(all columns), ts)`` keeps only one candidate per series in
    each task, so a hot series costs no more than any other.
    """
    keys = keys_of(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("_last")).select(*keys, "_last.*")
