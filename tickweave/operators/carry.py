"""One carry stage: running sums, fills and EMAs over row segments, fused.

Plan of a stage (``carry_stage``)::

    input --repartition(keys, _seg)--+--> windows inside each block (local values)
                                     |
                                     +--> totals per block and segment  (same shuffle, reused)
                                              --> multi-level scan of the small tables (``scan``)
    local values LEFT JOIN states ON (keys, _seg)  -->  final values

* The big side is shuffled once.  Block totals are plain aggregates of the
  *stage input* (sums, last / first non-null value, EMA block-end value), so
  they read the same shuffle output instead of recomputing the window stage;
  only EMAs over inputs with nulls need their local windows for them too.
* A block is the segment, or a part of it where an EMA needs smaller ones (large
  alpha, or large segments).  Windows over (keys, _seg, _g) and aggregates by them
  need no shuffle beyond the one on (keys, _seg), so a stage has the same
  shuffles at any segment size.
* All carried quantities of one stage share one scan and one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.core import col_of, nan_to_null
from tickweave.operators import scan
from tickweave.operators.ewm import Ema, block_rows, combined_carry, gap_carry, gap_first, plain_carry, power
from tickweave.operators.series import IDX, SEG, UNB_PREC, keys_of, segment_rows, with_segments
from tickweave.schema import KEYS

BLOCK = "_g"


def _weight(s) -> Column:
    """Weight of a row's input: none before the seed row, 1 on it, alpha after it.
    A null after the seed row has no plain weight: the job fails instead of
    giving a wrong average (fill the column, or use ``gaps``)."""
    i = F.col(IDX)
    message = F.lit(f"EMA {s.out}: its input has a null; fill it first or use gaps=True")
    return F.when(i < s.start, F.lit(0.0)).when(col_of(s.x).isNull(), F.raise_error(message).cast("double")).when(i == s.start, F.lit(1.0)).otherwise(F.lit(s.alpha))


class _Stage:
    """What a stage adds, in the order in which it is computed."""

    def __init__(self, keys: list[str], part: list[str], rows: int):
        self.keys, self.part, self.rows = keys, part, rows
        self.layers: list[list[Column]] = [[], [], [], []]  # window columns; later layers use earlier ones
        self.carries: list[scan.Carry] = []
        self.final: dict[str, Column] = {}
        self.upto = Window.partitionBy(*part).orderBy(IDX).rowsBetween(UNB_PREC, 0)
        self.before = Window.partitionBy(*part).orderBy(IDX).rowsBetween(UNB_PREC, -1)
        # Frames that reach to the end are written as growing frames over the
        # reversed order: Spark re-aggregates a shrinking "to unbounded
        # following" frame for every row (quadratic), a growing one incrementally.
        self.onward = Window.partitionBy(*part).orderBy(F.col(IDX).desc()).rowsBetween(UNB_PREC, 0)
        self.j = F.pmod(F.col(IDX), F.lit(rows))  # place in the block

    def sum(self, out: str, term) -> None:
        t = F.coalesce(col_of(term), F.lit(0.0))
        self.layers[0].append(F.sum(t).over(self.upto).alias(f"_l_{out}"))
        self.carries.append(scan.running(f"_c_{out}", t))
        self.final[out] = F.col(f"_l_{out}") + F.col(f"_c_{out}")

    def forward(self, c: str, dtype: str) -> list[Column]:
        self.layers[0].append(F.last(c, ignorenulls=True).over(self.upto).alias(f"_lf_{c}"))
        self.carries.append(scan.latest(f"_cf_{c}", F.col(c), F.col(IDX), dtype))
        return [F.col(f"_lf_{c}"), F.col(f"_cf_{c}")]

    def backward(self, c: str, dtype: str) -> list[Column]:
        self.layers[0].append(F.last(c, ignorenulls=True).over(self.onward).alias(f"_lb_{c}"))
        self.carries.append(scan.latest(f"_cb_{c}", F.col(c), F.col(IDX), dtype, backward=True))
        return [F.col(f"_lb_{c}"), F.col(f"_cb_{c}")]

    def ema(self, s: Ema) -> None:
        lam, x, w = 1.0 - s.alpha, F.coalesce(col_of(s.x), F.lit(0.0)), _weight(s)
        self.layers[0].append((power(lam, self.j) * F.sum(w * x * power(lam, -self.j)).over(self.upto)).alias(f"_le_{s.out}"))
        end = F.sum(w * x * power(lam, F.lit(self.rows - 1) - self.j))
        self.carries.append(plain_carry(f"_ce_{s.out}", end, lam, self.rows))
        self.final[s.out] = F.when(F.col(IDX) >= s.start, F.col(f"_le_{s.out}") + power(lam, self.j + 1) * F.col(f"_ce_{s.out}"))

    def last_value(self, s: Ema) -> None:
        """An EMA of alpha 1 over an input with nulls: the last value."""
        x = F.when(F.col(IDX) >= s.start, nan_to_null(col_of(s.x).cast("double")))
        self.layers[0].append(F.last(x, ignorenulls=True).over(self.upto).alias(f"_lf_{s.out}"))
        self.carries.append(scan.latest(f"_cf_{s.out}", x, F.col(IDX), "double"))
        self.final[s.out] = F.coalesce(f"_lf_{s.out}", f"_cf_{s.out}")

    def gap_ema(self, s: Ema) -> None:
        o, lam, a = s.out, 1.0 - s.alpha, F.lit(s.alpha)
        i, x = F.col(IDX), F.when(F.col(IDX) >= s.start, nan_to_null(col_of(s.x).cast("double")))
        here = F.col(f"_x_{o}").isNotNull()
        place = i if s.place is None else s.place
        at = F.when(here, place)
        self.layers[0].append(x.alias(f"_x_{o}"))
        self.layers[1] += [F.last(at, ignorenulls=True).over(self.before).alias(f"_b_{o}"), F.min(at).over(self.upto).alias(f"_f_{o}"), F.first(f"_x_{o}", ignorenulls=True).over(self.upto).alias(f"_xf_{o}")]
        # p: how much of the average at the block's first value is left; 1 / (lam^d + a) once per gap
        distance = place - F.col(f"_b_{o}")
        follows = here & F.col(f"_b_{o}").isNotNull()
        sum_of_weights = power(lam, distance) + a
        gap = F.sum(F.when(follows & (distance > 1), F.ln(sum_of_weights)).otherwise(F.lit(0.0))).over(self.upto)
        newest = F.when(here, place).otherwise(F.col(f"_b_{o}"))
        self.layers[2].append((power(lam, newest - F.col(f"_f_{o}")) * F.exp(-gap)).alias(f"_p_{o}"))
        gain = F.when(follows, F.when(distance > 1, a / sum_of_weights).otherwise(a) * F.col(f"_x_{o}") / F.col(f"_p_{o}")).otherwise(F.lit(0.0))
        self.layers[3].append((F.col(f"_p_{o}") * F.sum(gain).over(self.upto)).alias(f"_y_{o}"))
        self.carries.append(
            gap_carry(f"_ce_{o}", s, F.min(at), F.min_by(f"_x_{o}", at), F.max_by(f"_p_{o}", IDX), F.max_by(f"_y_{o}", IDX), F.max(at))
        )
        state = F.col(f"_ce_{o}")
        first = F.expr(gap_first(s, scan.quoted(f"_ce_{o}"), scan.quoted(f"_f_{o}"), scan.quoted(f"_xf_{o}")))
        self.final[o] = F.when(F.col(f"_f_{o}").isNotNull(), F.col(f"_p_{o}") * first + F.col(f"_y_{o}")).otherwise(state["c"])


def carry_stage(
    df: DataFrame,
    keys=KEYS,
    seg_rows: int | None = None,
    sums: dict[str, Column] | None = None,
    ffill: Sequence[str] = (),
    bfill: Sequence[str] = (),
    fill_chain: Sequence[str] = (),
    fill_value: float | None = 0.0,
    emas: Sequence[Ema] = (),
    max_block: int | None = None,
    partitioned: bool = False,
    ema_combos: Sequence = (),
) -> DataFrame:
    """Add / replace columns that need state from all earlier (or later) rows.

    ``sums``: ``{out: term}`` running sums (null terms count 0).
    ``ffill`` / ``bfill``: columns filled in place from earlier / later rows.
    ``fill_chain``: columns filled ffill, then bfill, then ``fill_value``
    (``bfill(ffill(x)) == coalesce(ffill(x), bfill(x))``).
    ``emas``: ``Ema`` specs (see ``ewm``).  ``df`` needs the dense ``_i``.
    ``ema_combos``: ``EmaOfEmas`` specs - an EMA of a linear combination of
    EMAs of this stage (the MACD signal), solved in the same stage (see
    ``_combo``).
    ``partitioned``: the input comes straight from a stage already hash
    partitioned on ``(keys, _seg)`` (a halo window, ``regularise``); skip the
    explicit repartition and let both branches read that stage's shuffle (its
    cheap last step runs twice instead of shuffling all rows again).
    """
    keys = keys_of(keys)
    seg_rows = segment_rows(df, seg_rows)
    rows = min([seg_rows, *(block_rows(s.alpha, seg_rows, max_block) for s in [*emas, *ema_combos])])
    whole = rows == seg_rows
    d = with_segments(df, seg_rows)
    if not partitioned:
        d = d.repartition(*keys, SEG)
    if not whole:
        d = d.withColumn(BLOCK, F.floor(F.col(IDX) / F.lit(rows)).cast("long"))
    stage = _Stage(keys, [*keys, SEG] if whole else [*keys, SEG, BLOCK], rows)

    types = dict(df.dtypes)
    for out, term in (sums or {}).items():
        stage.sum(out, term)
    chain = [c for c in fill_chain if c in df.columns]
    fwd = {c: stage.forward(c, types[c]) for c in dict.fromkeys([*ffill, *chain])}
    bwd = {c: stage.backward(c, types[c]) for c in dict.fromkeys([*bfill, *chain])}
    for c in ffill:
        stage.final[c] = F.coalesce(*fwd[c])
    for c in bfill:
        stage.final[c] = F.coalesce(*bwd[c])
    for c in chain:
        stage.final[c] = F.coalesce(*fwd[c], *bwd[c], *([] if fill_value is None else [F.lit(fill_value)]))
    for s in emas:
        (stage.ema if not s.gaps else stage.last_value if s.alpha >= 1 else stage.gap_ema)(s)
    by_name = {s.out: s for s in emas}
    stage.carries += [_combo(c, by_name, stage) for c in ema_combos]
    if not stage.carries:
        return d.drop(BLOCK)

    local = d
    for layer in stage.layers:
        local = local.select("*", *layer) if layer else local
    gaps = any(s.gaps for s in emas)
    states = scan.segment_states(local if gaps else d, keys, SEG, None if whole else BLOCK, seg_rows // rows, stage.carries)
    out = local.join(states, [*keys, SEG], "left")
    if not whole:  # the block's own state
        place = (F.col(BLOCK) - F.col(SEG) * F.lit(seg_rows // rows) + 1).cast("int")
        out = out.select(*[c for c in local.columns], *[F.element_at(c.name, place).alias(c.name) for c in stage.carries])
    for c in ema_combos:
        # The combination is known per row only after the inner states are
        # joined; its local prefix sum is one more window on the same
        # partitioning (no shuffle).
        mu = 1.0 - c.alpha
        m = sum((F.lit(float(coef)) * stage.final[name] for name, coef in c.terms.items()), F.lit(0.0))
        w = F.when(F.col(IDX) == 0, F.lit(1.0)).otherwise(F.lit(c.alpha))
        out = out.select("*", (power(mu, stage.j) * F.sum(w * m * power(mu, -stage.j)).over(stage.upto)).alias(f"_le_{c.out}"))
        stage.final[c.out] = F.col(f"_le_{c.out}") + power(mu, stage.j + 1) * F.col(f"_ce_{c.out}")["o"]
    keep = [c for c in df.columns if c not in stage.final]
    if SEG not in keep:
        keep.append(SEG)
    return out.select(*keep, *[e.alias(n) for n, e in stage.final.items()])


def _combo(c, by_name: dict, stage: _Stage) -> scan.Carry:
    """The carried state of an EMA (factor ``mu``) of ``m = sum_k a_k y_k``, where ``y_k`` are
    EMAs (factor ``lam_k``) of this stage, all seeded on row 0.

    Inside block g of ``b`` rows, ``y_k(j) = L_k(j) + lam_k^(j+1) C_k(g)``.  The block-end
    value of the outer EMA's local part is
    ``T(g) = sum_k a_k (U_k(g) + C_k(g) V_k(g))`` with
    ``V_k = sum_j w(j) mu^(b-1-j) lam_k^(j+1)`` and
    ``U_k = sum_j w(j) mu^(b-1-j) L_k(j) = sum_s w_k(s) x_k(s) G_k(s)``,
    ``G_k(s) = sum_{j>=s} w(j) mu^(b-1-j) lam_k^(j-s)``, a geometric sum
    ``a (mu^n - lam^n) / (mu - lam)`` with ``n = b - s`` (plus the seed
    row's own weight on row 0).  U and V are plain aggregates of the input,
    so the outer EMA needs no second shuffle.
    """
    mu, b, j, i = 1.0 - c.alpha, stage.rows, stage.j, F.col(IDX)
    n = F.lit(b) - j
    w_out = F.when(i == 0, F.lit(1.0)).otherwise(F.lit(c.alpha))
    inner = []
    for name, coef in c.terms.items():
        s = by_name.get(name)
        if s is None or s.start != 0 or s.gaps:
            raise ValueError(f"{c.out}: term {name} must be an EMA of this stage without gaps, seeded on row 0")
        lam = 1.0 - s.alpha
        x = F.coalesce(col_of(s.x), F.lit(0.0))
        w = F.when(col_of(s.x).isNull(), F.lit(0.0)).when(i == 0, F.lit(1.0)).otherwise(F.lit(s.alpha))
        geo = n.cast("double") * power(lam, n - 1) if abs(mu - lam) < 1e-12 else (power(mu, n) - power(lam, n)) / F.lit(mu - lam)
        g = F.lit(c.alpha) * geo + F.when(i == 0, F.lit((1.0 - c.alpha) * mu ** (b - 1))).otherwise(F.lit(0.0))
        end = F.sum(w * x * power(lam, F.lit(b - 1) - j))
        inner.append((float(coef), lam, end, F.sum(w * x * g), F.sum(w_out * power(mu, F.lit(b - 1) - j) * power(lam, j + 1))))
    return combined_carry(f"_ce_{c.out}", inner, mu, b)
