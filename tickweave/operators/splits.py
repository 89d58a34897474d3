"""Time-ordered and random splits.

All splits work per series from the dense row index ``_i`` and the series
length (a one-row-per-series aggregate joined back), so no window ever holds a
whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.operators.scan import offsets
from tickweave.operators.series import IDX, ensure_index, keys_of
from tickweave.schema import KEYS, TS


def _with_length(df: DataFrame, keys) -> DataFrame:
    keys = keys_of(keys)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return ensure_index(df, keys).join(n, keys, "left")


def holdout(df: DataFrame, ratio: float = 0.2, keys=KEYS, out: str = "split") -> DataFrame:
    """first ``floor(n * (1 - ratio))`` rows of each series train, the rest test."""
    d = _with_length(df, keys)
    cut = F.floor(F.col("_n") * F.lit(1.0 - ratio))
    return d.withColumn(out, F.when(F.col(IDX) < cut, F.lit("train")).otherwise(F.lit("test"))).drop("_n")


HASH_BUCKETS = 1 << 20


def hash_fraction(*cols, seed: int = 42) -> Column:
    """Repeatable uniform number in [0, 1) from the row key (no RNG state): the
    first 32 bits of the md5 of ``seed|col|col...`` as text, so any SQL engine
    gives the same split."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def random_split(df: DataFrame, ratio: float = 0.2, keys=KEYS, ts: str = TS, seed: int = 42, stratify: str | None = None, out: str = "split") -> DataFrame:
    """repeatable random split by a hash of the row key.

    ``stratify``: inside each class, rows are ranked by the hash and the top
    ``ratio`` share goes to test, so class shares match exactly (like a
    stratified split).  The rank runs per (class, hash bucket) with bucket
    offsets from a multi-level sum of bucket counts, so a big class is not one task;
    there are 2^20 buckets, so a bucket holds a millionth of its class.
    """
    u = hash_fraction(*keys_of(keys), ts, seed=seed)
    if stratify is None:
        return df.withColumn(out, F.when(u < F.lit(ratio), F.lit("test")).otherwise(F.lit("train")))
    d = df.withColumn("_u", u).withColumn("_ub", F.floor(F.col("_u") * HASH_BUCKETS).cast("long"))
    cnt = d.groupBy(stratify, "_ub").agg(F.count(F.lit(1)).alias("_c"))
    sizes = cnt.groupBy(F.col(stratify).alias("_class")).agg(F.sum("_c").alias("_nc"))
    cnt = offsets(cnt.withColumnRenamed(stratify, "_class").withColumnRenamed("_ub", "_cb"), ["_class"], "_cb", "_c", "_off")
    same = F.col(stratify).eqNullSafe(F.col("_class"))  # rows without a class are a class
    d = d.join(cnt, same & (F.col("_ub") == F.col("_cb")), "left").drop("_class", "_cb")
    d = d.join(sizes, same, "left").drop("_class")
    rank = F.col("_off") + F.row_number().over(Window.partitionBy(stratify, "_ub").orderBy("_u", *keys_of(keys), ts)) - 1
    n_test = F.ceil(F.col("_nc") * F.lit(ratio))
    return d.withColumn(out, F.when(rank < n_test, F.lit("test")).otherwise(F.lit("train"))).drop("_u", "_ub", "_off", "_nc")


def walk_forward(df: DataFrame, n_splits: int = 5, keys=KEYS, min_test: int = 20) -> DataFrame:
    """block size ``n // (n_splits + 1)``; fold i (1-based) trains on the
    first ``i`` blocks and tests on block ``i + 1``; folds with fewer than
    ``min_test`` test rows are dropped (the reference stops there).  Rows after
    the last full block are in no fold.

    Output: one row per (row, fold) it belongs to, with ``fold`` and ``role``.
    Each row joins at most ``n_splits`` folds (explode of a bounded array).
    """
    d = _with_length(df, keys)
    size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    block = F.floor(F.col(IDX) / size)
    folds = [
        F.when(block < F.lit(i), F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
        .when(block == F.lit(i), F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role")))
        for i in range(1, n_splits + 1)
    ]
    d = d.withColumn("_size", size).filter(F.col("_size") >= F.lit(min_test))
    d = d.select("*", F.explode(F.filter(F.array(*folds), lambda x: x.isNotNull())).alias("_f"))
    return d.select(*[c for c in d.columns if c not in ("_f", "_n", "_size")], "_f.fold", "_f.role")


def time_series_folds(df: DataFrame, n_splits: int = 5, keys=KEYS) -> DataFrame:
    """scikit-learn ``TimeSeriesSplit``: test size ``n // (n_splits + 1)``,
    test blocks end at the last row, the remainder goes to the first train
    block.  Output as in ``walk_forward``."""
    d = _with_length(df, keys)
    size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    first_test = F.col("_n") - size * F.lit(n_splits)
    folds = []
    for i in range(1, n_splits + 1):
        start = first_test + size * F.lit(i - 1)
        folds.append(
            F.when(F.col(IDX) < start, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
            .when(F.col(IDX) < start + size, F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role")))
        )
    d = d.filter(size > 0).select("*", F.explode(F.filter(F.array(*folds), lambda x: x.isNotNull())).alias("_f"))
    return d.select(*[c for c in d.columns if c not in ("_f", "_n")], "_f.fold", "_f.role")
