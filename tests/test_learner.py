"""Online learner (F14): learns from micro-batches, resumes, ignores replays."""

import os
import tempfile

from pyspark.sql import functions as F

from tickweave.operators.splits import hash_fraction
from tickweave.streaming.learn import OnlineLogisticBag, poisson1


def _batch(spark, n=200, shift=0):
    df = spark.range(shift, shift + n).select(
        F.lit("A").alias("symbol"), F.col("id").alias("t"),
        (F.col("id") % 10).cast("double").alias("x"),
    )
    return df.withColumn("target", (F.col("x") >= 5).cast("int"))


def test_learns_resumes_and_skips_replays(spark):
    root = tempfile.mkdtemp(prefix="learner-")
    out, state = os.path.join(root, "pred"), os.path.join(root, "state")
    a = OnlineLogisticBag(spark, ["x"], "target", ["symbol", "t"], out, state, bags=3, lr=2.0)
    for e in range(6):
        a.process(_batch(spark, shift=200 * e), e)
    assert a.metrics()["seen"] == 1200
    late_acc = spark.read.parquet(out).filter(F.col("epoch") >= 3).agg(F.avg((F.col("pred") == F.col("y")).cast("double"))).first()[0]
    assert late_acc > 0.8  # a separable rule is learned
    b = OnlineLogisticBag(spark, ["x"], "target", ["symbol", "t"], out, state, bags=3, lr=2.0)
    assert b.last_epoch == 5 and b.w == a.w
    b.process(_batch(spark, shift=0), 5)  # replayed epoch: no change
    assert b.metrics()["seen"] == 1200 and b.w == a.w
    assert spark.read.parquet(out).count() == 1200


def test_batch_sums_and_probabilities_equal_sql(spark, tmp_path):
    """Sums of a batch against plain SQL over (row, bag), nulls included, and one row out of each task
    for a bag and sum: no row is copied for its bags."""
    df = spark.range(300).select(
        F.lit("A").alias("symbol"), F.col("id").alias("t"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 10).cast("double")).alias("x"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 2).cast("int")).alias("target"),
    )
    a = OnlineLogisticBag(spark, ["x"], "target", ["symbol", "t"], str(tmp_path / "out"), str(tmp_path / "state"), bags=3)
    a.n, a.mean, a.m2, a.w = 10.0, [4.0], [90.0], [[0.5, -0.25], [1.0, 0.0], [-2.0, 0.5]]
    got = {(r["bag"], r["j"]): r["g"] for r in a._gradients(df).collect()}
    x = (F.coalesce("x", F.lit(4.0)) - 4.0) / 3.0
    for b, (w, c) in enumerate(a.w):
        k = poisson1(hash_fraction("symbol", "t", F.lit(b)))
        err = k * (1.0 / (1.0 + F.exp(-(c + w * x))) - F.col("target"))
        want = df.agg(F.sum(err * x), F.sum(err), F.sum(k)).first()
        assert all(abs(u - v) < 1e-9 for u, v in zip(want, (got[b, 0], got[b, -1], got[b, -2])))
    assert len(got) == 9
    prob = sum(1.0 / (1.0 + F.exp(-(c + w * x))) for w, c in a.w) / 3.0
    pairs = a._scored(df).join(df.select("t", prob.alias("want")), "t")
    assert pairs.where(F.abs(F.col("prob") - F.col("want")) < 1e-12).count() == 300
    plan = a._gradients(df)._jdf.queryExecution().toString()
    assert "Generate explode" not in plan


def test_model_rows_are_written_once(spark, tmp_path):
    """Fits read the written features, target and split; the feature plan is not replayed."""
    from tickweave.plans.catalog_ml import model_frame

    plan = model_frame(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Scan ExistingRDD" in plan
