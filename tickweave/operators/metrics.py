"""Classification metrics (G1-G6, G8) as aggregates.

Every metric is grouped by ``by`` (e.g. the series key, a fold, or nothing for
one global figure).  Exact ranking metrics (AUC, PR curve) aggregate to one
row per distinct score first, then need a running sum in score order; that
running sum uses score buckets with carried bucket totals, so even a single
global group never puts all distinct scores in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.operators.series import IDX, running_sum


def _div0(a: Column, b: Column) -> Column:
    """``zero_division=0``: 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """G1: share of rows with ``pred == y``."""
    return df.groupBy(*by).agg(F.avg((F.col(pred) == F.col(y)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def precision_recall(df: DataFrame, y: str = "y", pred: str = "pred", positive=1, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of the positive class, 0 when undefined."""
    yp = F.col(y) == F.lit(positive)
    pp = F.col(pred) == F.lit(positive)
    agg = df.groupBy(*by).agg(
        F.sum((yp & pp).cast("long")).alias("tp"),
        F.sum(pp.cast("long")).alias("pred_pos"),
        F.sum(yp.cast("long")).alias("actual_pos"),
    )
    return agg.select(*by, _div0(F.col("tp"), F.col("pred_pos")).alias("precision"), _div0(F.col("tp"), F.col("actual_pos")).alias("recall"))


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", classes: Sequence | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Counts with actual class as rows and predicted class as columns.

    The full square of every class found as ``y`` or ``pred`` (and of those in
    ``classes``), zeros included; the classes found are one distinct value
    each.  Rows with a null ``y`` or ``pred`` belong to no cell.
    """
    by = list(by)
    d = df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull())
    found = {r[0] for r in d.select(F.explode(F.array_distinct(F.array(y, F.col(pred).cast(dict(d.dtypes)[y])))).alias("c")).distinct().collect()}
    names = sorted({*found, *(classes or ())})
    if not names:
        return d.select(*by, y).limit(0)
    counts = d.groupBy(*by, y).pivot(pred, names).count()
    rows = F.explode(F.array(*[F.lit(c) for c in names]).cast(f"array<{dict(d.dtypes)[y]}>")).alias(y)
    square = d.select(*by).distinct().select(*by, rows) if by else d.limit(1).select(rows)
    return square.join(counts, [*by, y], "left").na.fill(0, subset=[str(c) for c in names])


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Per-class precision, recall, f1, support, plus accuracy, macro and
    weighted averages (``zero_division=0``).

    Each row counts once for its true class and once for its predicted class
    (an explode of two entries), so one grouped aggregate gives every count.
    """
    by = list(by)
    e = df.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col(y).cast("string").alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"), (F.col(y) == F.col(pred)).cast("int").alias("tp")),
                F.struct(F.col(pred).cast("string").alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("tp")),
            )
        ).alias("e"),
    )
    per = e.groupBy(*by, "e.cls").agg(F.sum("e.t").alias("support"), F.sum("e.p").alias("predicted"), F.sum("e.tp").alias("tp"))
    per = per.select(
        *by,
        F.col("cls").alias("class"),
        _div0(F.col("tp"), F.col("predicted")).alias("precision"),
        _div0(F.col("tp"), F.col("support")).alias("recall"),
        "support",
        "tp",
    )
    per = per.withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    tot = per.groupBy(*by).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _div0(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        _div0(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        _div0(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"),
        F.sum("support").alias("n"),
        _div0(F.sum("tp"), F.sum("support")).alias("acc"),
    )
    cols = ["precision", "recall", "f1", "support"]
    rows = [per.select(*by, "class", *cols)]
    rows.append(tot.select(*by, F.lit("accuracy").alias("class"), F.col("acc").alias("precision"), F.col("acc").alias("recall"), F.col("acc").alias("f1"), F.col("n").alias("support")))
    rows.append(tot.select(*by, F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")))
    rows.append(tot.select(*by, F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _grouped(df: DataFrame, by: Sequence[str]):
    """A constant group key when none is given, so every step stays an equi-join."""
    if by:
        return df, list(by), []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def _score_table(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"),
        F.sum((F.col(y) != 1).cast("long")).alias("neg"),
    )


SCORES_PER_BUCKET = 50_000


def _score_buckets(t: DataFrame, by: list[str], s: Column, buckets: int | None) -> DataFrame:
    """``t`` with ``_sb``: the bucket of each distinct score within its group, in order of ``s``.

    A group's scores are cut at approximate quantiles of its own distinct scores, into as many
    buckets as the largest group needs for about ``SCORES_PER_BUCKET`` scores each (measured;
    ``buckets`` states a number instead).  A row finds its bucket in two steps, among every
    ``side``-th cut and then the ``side`` cuts behind it.
    """
    if buckets is None:
        buckets = -(-(t.groupBy(*by).count().agg(F.max("count")).first()[0] or 1) // SCORES_PER_BUCKET)
    if buckets < 2:
        return t.withColumn("_sb", F.lit(0).cast("long"))
    side = math.isqrt(buckets - 1) + 1
    cuts = t.groupBy(*by).agg(F.percentile_approx(s.cast("double"), [i / buckets for i in range(1, buckets)], 10 * buckets).alias("_q"))
    cuts = cuts.withColumn("_tops", F.filter("_q", lambda c, i: i % side == side - 1))
    t = t.join(cuts, by, "left")
    above = F.size(F.filter("_tops", lambda c: c <= s)) * side
    t = t.withColumn("_sa", F.greatest(above, F.lit(0)))
    near = F.size(F.filter(F.slice("_q", F.col("_sa") + 1, F.lit(side)), lambda c: c <= s))
    return t.withColumn("_sb", (F.col("_sa") + F.greatest(near, F.lit(0))).cast("long")).drop("_q", "_tops", "_sa")


def _running_by_score(t: DataFrame, by: Sequence[str], cols: Sequence[str], descending: bool, buckets: int | None) -> DataFrame:
    """Running sums of ``cols`` in score order, *excluding* the current score.

    Bucket totals (see ``_score_buckets``) are carried over a small per-bucket table and the
    in-bucket running sum is a window over one bucket only.  Null scores come first, NaN last
    (``descending``: first).
    """
    by = list(by)
    s = -F.col("score") if descending else F.col("score")
    t = _score_buckets(t, by, s, buckets)
    tot = t.groupBy(*by, "_sb").agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    bw = Window.partitionBy(*by).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*by, "_sb", *[F.coalesce(F.sum(f"_bt_{c}").over(bw), F.lit(0)).alias(f"_bp_{c}") for c in cols])
    t = t.join(tot, [*by, "_sb"], "left")
    iw = Window.partitionBy(*by, "_sb").orderBy(s).rowsBetween(Window.unboundedPreceding, -1)
    return t.select(
        *[c for c in t.columns if not c.startswith("_b") and c != "_sb"],
        *[(F.col(f"_bp_{c}") + F.coalesce(F.sum(c).over(iw), F.lit(0))).alias(f"before_{c}") for c in cols],
    )


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with tied scores averaged (Mann-Whitney form):
    ``sum_s pos_s * (neg below s + neg at s / 2) / (P * N)``."""
    df, by, drop = _grouped(df, by)
    t = _running_by_score(_score_table(df, y, score, by), by, ["neg"], descending=False, buckets=buckets)
    return t.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / F.lit(2.0))),
            F.sum("pos").cast("double") * F.sum("neg").cast("double"),
        ).alias("roc_auc")
    ).drop(*drop)


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (), buckets: int | None = None, eps: float = 1e-12) -> DataFrame:
    """The precision-recall curve, one row per distinct score (the
    threshold): ``threshold, precision, recall, f1 = 2pr / (p + r + eps)``."""
    t, by, drop = _curve(df, y, score, by, buckets, eps)
    return t.select(*by, F.col("score").alias("threshold"), "precision", "recall", "f1").drop(*drop)


def best_f1_threshold(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (), buckets: int | None = None, eps: float = 1e-12) -> DataFrame:
    """The threshold of the precision-recall curve with the best F1
    (lowest threshold on ties, like ``argmax`` over increasing thresholds)."""
    t, by, drop = _curve(df, y, score, by, buckets, eps)
    res = t.groupBy(*by).agg(
        F.max_by("score", F.struct(F.col("f1"), -F.col("score"))).alias("best_threshold"),
        F.max("f1").alias("best_f1"),
    )
    return res.drop(*drop)


def _curve(df: DataFrame, y: str, score: str, by: Sequence[str], buckets: int, eps: float):
    df, by, drop = _grouped(df, by)
    t = _running_by_score(_score_table(df, y, score, by), by, ["pos", "neg"], descending=True, buckets=buckets)
    t = t.withColumn("tp", F.col("before_pos") + F.col("pos")).withColumn("fp", F.col("before_neg") + F.col("neg"))
    totals = t.groupBy(*by).agg(F.sum("pos").alias("_P"))
    t = t.join(totals, by, "left")
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("_P"))
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    return t.withColumn("f1", F.lit(2.0) * prec * rec / (prec + rec + F.lit(eps))), by, drop


def prequential(df: DataFrame, y: str = "y", pred: str = "pred", keys=("symbol", "timeframe"), every: int = 50) -> DataFrame:
    """Running accuracy, precision and recall in time order (predict, then
    learn), snapshotted every ``every`` rows of each series.  Running sums use
    the segment carry of ``series`` (needs ``_i``)."""
    yp, pp = F.col(y) == 1, F.col(pred) == 1
    d = running_sum(
        df,
        {
            "_ok": (F.col(y) == F.col(pred)).cast("double"),
            "_tp": (yp & pp).cast("double"),
            "_pp": pp.cast("double"),
            "_ap": yp.cast("double"),
        },
        keys,
    )
    n = F.col(IDX) + 1
    d = d.filter(n % F.lit(every) == 0)
    return d.select(
        *keys,
        "timestamp",
        n.alias("seen"),
        (F.col("_ok") / n).alias("accuracy"),
        _div0(F.col("_tp"), F.col("_pp")).alias("precision"),
        _div0(F.col("_tp"), F.col("_ap")).alias("recall"),
    )
