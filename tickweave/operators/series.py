"""Series layout: dense row index, row segments, halo rows, carried state.

Why this exists
---------------
A bar series is ordered data: lags, rolling windows, running sums, fills and
the EMA all look at earlier rows.  ``Window.partitionBy(symbol, timeframe)``
puts one whole series in one task, so a hot series (assume one may hold a
third of all rows) becomes one straggler that may not fit in memory.

Instead every series gets a dense 0-based row index ``_i`` and is cut into
segments of ``seg_rows`` rows (``_seg = _i div seg_rows``).  Window work is
partitioned by ``(keys, _seg)``:

* bounded look-back / look-ahead (lag, lead, rolling n) - each segment gets a
  *halo*: copies of the last ``back`` rows of the previous segment and the first
  ``fwd`` rows of the next one (``with_halo``).  One exchange, no whole-series
  task, ``back/seg_rows`` extra rows.
* unbounded state (running sum, forward/back fill, EMA) - see ``carry``: one
  exchange on ``(keys, _seg)``; each segment computes its local result, a
  plain aggregate of the same shuffled rows gives one summary row per
  segment, a multi-level scan over that small table (``scan``) carries state
  across segments, and the carry is joined back on ``(keys, _seg)``.

The index must be dense (0..n-1 without holes).  Operators that drop rows call
``index_rows`` again before further window work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.core import epoch_us, tf_seconds
from tickweave.operators.scan import offsets
from tickweave.schema import KEYS, TS

IDX = "_i"
SEG = "_seg"
ROLE = "_role"  # 0 = row of this segment, -1 = look-back copy, 1 = look-ahead copy
SEGMENT_ROWS = 1024
SEGMENT_CONF = "spark.tickweave.segmentRows"

UNB_PREC = Window.unboundedPreceding
UNB_FOLL = Window.unboundedFollowing


def segment_rows(df: DataFrame, seg_rows: int | None = None) -> int:
    """Rows per segment: the argument, else the session setting
    ``spark.tickweave.segmentRows``, else 1024.  Must be a power of two (EMA
    blocks nest in segments).  Larger segments keep the per-series segment
    tables small on very long series (e.g. 65536 on a large cluster)."""
    if seg_rows is None:
        try:
            seg_rows = int(df.sparkSession.conf.get(SEGMENT_CONF, str(SEGMENT_ROWS)))
        except Exception:  # noqa: BLE001 - no session attached (plain Column use)
            seg_rows = SEGMENT_ROWS
    if seg_rows < 2 or seg_rows & (seg_rows - 1):
        raise ValueError(f"segment rows must be a power of two, got {seg_rows}")
    return seg_rows


def keys_of(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def seg_expr(seg_rows: int = SEGMENT_ROWS) -> Column:
    return F.floor(F.col(IDX) / F.lit(seg_rows)).cast("long")


def index_rows(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    bucket_us: int | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``_i``: dense 0-based row position inside each series by ``ts``.

    Distributed numbering: rows are put in time buckets of about
    ``SEGMENT_ROWS`` bars (from the ``timeframe`` column, else one day), counted
    per (series, bucket), and bucket offsets come from a multi-level sum over the
    small count table (``scan.offsets``).  ``row_number`` then runs only inside
    one (series, bucket), never over a whole series.

    A row without a time or a series key has no place in a series: the job
    fails with a message that says so (drop or repair such rows first, e.g.
    ``clean.drop_nulls``); rows are never lost.
    """
    keys = keys_of(keys)
    t = epoch_us(df, ts)
    if bucket_us is not None:
        step = F.lit(int(bucket_us))
    elif "timeframe" in df.columns:
        step = F.coalesce(tf_seconds("timeframe") * F.lit(1_000_000 * segment_rows(df)), F.lit(86_400_000_000))
    else:
        step = F.lit(86_400_000_000)
    src = df.drop(IDX) if IDX in df.columns else df
    lost = F.col(ts).isNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    message = F.lit(f"index_rows: a row has no {ts} or no series key ({', '.join(keys)}); drop or repair such rows first")
    d = src.withColumn("_b", F.when(lost, F.raise_error(message)).otherwise(F.floor(t / step)).cast("long"))
    counts = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    d = d.join(offsets(counts, keys, "_b", "_n", "_off"), [*keys, "_b"], "left")  # an inner join would filter null keys before the check sees them
    ordering = [F.col(ts)] + [F.col(c) for c in (order or [])]
    w = Window.partitionBy(*keys, "_b").orderBy(*ordering)
    return d.withColumn(IDX, (F.col("_off") + F.row_number().over(w) - 1).cast("long")).drop("_b", "_off")


def ensure_index(df: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    return df if IDX in df.columns else index_rows(df, keys, ts)


def with_halo(df: DataFrame, back: int = 0, fwd: int = 0, seg_rows: int | None = None) -> DataFrame:
    """Add ``_seg`` and ``_role``; copy the rows a segment's windows need.

    Row ``i`` always belongs to segment ``i div seg_rows`` (role 0).  If it is
    one of the last ``back`` rows of its segment it is also copied into the next
    segment (role -1); if it is one of the first ``fwd`` rows, into the previous
    one (role 1).  Windows ``partitionBy(keys, _seg).orderBy(_i)`` then see
    every row they need; keep role 0 afterwards (``main_rows``).
    """
    seg_rows = segment_rows(df, seg_rows)
    if back > seg_rows or fwd > seg_rows:
        raise ValueError(f"halo ({back}, {fwd}) larger than the segment ({seg_rows})")
    seg = seg_expr(seg_rows)
    pos = F.col(IDX) - seg * F.lit(seg_rows)
    if back == 0 and fwd == 0:
        return df.withColumn(SEG, seg).withColumn(ROLE, F.lit(0))
    items = [F.struct(seg.alias("s"), F.lit(0).alias("r"))]
    if back:
        items.append(F.when(pos >= seg_rows - back, F.struct((seg + 1).alias("s"), F.lit(-1).alias("r"))))
    if fwd:
        items.append(F.when((pos < fwd) & (seg > 0), F.struct((seg - 1).alias("s"), F.lit(1).alias("r"))))
    h = F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("_h")
    cols = [c for c in df.columns if c not in (SEG, ROLE)]
    return df.select(*cols, h).select(*cols, F.col("_h.s").alias(SEG), F.col("_h.r").alias(ROLE))


def with_halo_local(df: DataFrame, back: int = 0, fwd: int = 0, seg_rows: int | None = None, keys=KEYS) -> DataFrame:
    """``with_halo`` for input already hash partitioned on ``(keys, _seg)``
    (the output of ``regularise`` or of a carry stage): no full shuffle.

    The last ``back`` rows of every segment (and the first ``fwd``) form a
    small table, one row per segment with a bounded array; it is left-joined
    on ``(keys, _seg)`` onto only the first (last) row of the neighbouring
    segment - the big side keeps its partitioning, only the small table
    moves (or is broadcast) - and an explode adds the halo rows inside the
    partition.  Same rows and roles as ``with_halo``.
    """
    seg_rows = segment_rows(df, seg_rows)
    keys = keys_of(keys)
    if back > seg_rows or fwd > seg_rows:
        raise ValueError(f"halo ({back}, {fwd}) larger than the segment ({seg_rows})")
    base = with_segments(df, seg_rows)
    d = base
    # Keys and _seg stay the original columns (every generated row belongs to
    # the series and segment of the row that carries it), so Spark keeps the
    # (keys, _seg) partitioning through the explode.
    cols = [c for c in base.columns if c not in (ROLE, SEG, *keys)]
    pos = F.col(IDX) - F.col(SEG) * F.lit(seg_rows)

    def rows(role: int) -> Column:
        return F.struct(*[F.col(c) for c in cols], F.lit(role).alias(ROLE))

    own = rows(0)
    empty = F.filter(F.array(own), lambda x: F.lit(False))
    parts = [F.array(own)]
    if back:
        tails = base.filter(pos >= seg_rows - back).groupBy(*keys, (F.col(SEG) + 1).alias("_hs")).agg(F.collect_list(rows(-1)).alias("_tail"))
        tails = tails.select(*[F.col(k).alias(f"_hk_{k}") for k in keys], "_hs", "_tail")
        cond = [d[k] == tails[f"_hk_{k}"] for k in keys] + [d[SEG] == tails["_hs"], pos == 0]
        d = d.join(tails, cond, "left").drop(*[f"_hk_{k}" for k in keys], "_hs")
        parts.append(F.coalesce(F.col("_tail"), empty))
    if fwd:
        heads = base.filter((pos < fwd) & (F.col(SEG) > 0)).groupBy(*keys, (F.col(SEG) - 1).alias("_hs2")).agg(F.collect_list(rows(1)).alias("_head"))
        heads = heads.select(*[F.col(k).alias(f"_hk2_{k}") for k in keys], "_hs2", "_head")
        cond = [d[k] == heads[f"_hk2_{k}"] for k in keys] + [d[SEG] == heads["_hs2"], pos == seg_rows - 1]
        d = d.join(heads, cond, "left").drop(*[f"_hk2_{k}" for k in keys], "_hs2")
        parts.append(F.coalesce(F.col("_head"), empty))
    h = F.explode(F.concat(*parts)).alias("_h")
    return d.select(*keys, SEG, h).select(*keys, SEG, "_h.*")


def main_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(ROLE) == 0).drop(ROLE)


def seg_window(keys=KEYS) -> Window:
    """The one window spec shared by all row-level window work."""
    return Window.partitionBy(*keys_of(keys), SEG).orderBy(IDX)


def rows_back(n: int, keys=KEYS):
    """Frame of the current row and the ``n-1`` rows before it."""
    return seg_window(keys).rowsBetween(-(n - 1), 0)


def with_segments(df: DataFrame, seg_rows: int | None = None) -> DataFrame:
    return df if SEG in df.columns else df.withColumn(SEG, seg_expr(segment_rows(df, seg_rows)))


def running_sum(df: DataFrame, exprs: dict[str, Column], keys=KEYS, seg_rows: int | None = None, partitioned: bool = False) -> DataFrame:
    """Running sum from the series start for each ``{out: expr}`` (null terms count 0)."""
    from tickweave.operators.carry import carry_stage

    return carry_stage(df, keys, seg_rows, sums=exprs, partitioned=partitioned)


def fill_forward(df: DataFrame, cols: Sequence[str], keys=KEYS, seg_rows: int | None = None) -> DataFrame:
    """pandas ``ffill``: last non-null value at or before each row."""
    from tickweave.operators.carry import carry_stage

    return carry_stage(df, keys, seg_rows, ffill=[c for c in cols if c in df.columns])


def fill_backward(df: DataFrame, cols: Sequence[str], keys=KEYS, seg_rows: int | None = None) -> DataFrame:
    """pandas ``bfill``: first non-null value at or after each row."""
    from tickweave.operators.carry import carry_stage

    return carry_stage(df, keys, seg_rows, bfill=[c for c in cols if c in df.columns])


def series_count(df: DataFrame, keys=KEYS) -> DataFrame:
    """Rows per series as a small table (one row per series)."""
    return df.groupBy(*keys_of(keys)).agg(F.count(F.lit(1)).alias("_series_rows"))


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(IDX, SEG, ROLE)
