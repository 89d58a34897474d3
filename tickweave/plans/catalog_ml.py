"""Registered model queries.

Model outputs depend on the learner, so most get the rows-only check; F7's
boosting is checked by its key set and properties, F16 (stale registry entries) is
plain SQL.  All train on
indicator features of the 1h event bars with the next-bar target and a
chronological 80 / 20 split per series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions.core import rounded
from tickweave.operators import boosting
from tickweave.operators import labels as lab
from tickweave.operators import ml
from tickweave.operators import splits as spl
from tickweave.operators.bars import latest_per_series
from tickweave.operators.indicators import indicators
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import KEYS_SQL, query
from tickweave.plans.catalog_eval import _D4_SQL
from tickweave.plans.catalog_sources import scratch
from tickweave.plans.inputs import bars_cte, event_bars, table
from tickweave.schema import INDICATOR_COLS, KEYS, PRICE_COLS, TS
from tickweave.session import ensure_checkpoint_dir

FEATURES = [c for c in (*PRICE_COLS, *INDICATOR_COLS) if c != "spread"]
GBT = dict(maxIter=20, maxDepth=4, stepSize=0.1)


def model_frame(spark, sf):
    """Features, target and split of every bar, written once: a fit passes over its rows dozens of times."""
    ensure_checkpoint_dir(spark)
    d = indicators(event_bars(spark, sf)).drop("_i")
    d = lab.next_bar_up(d, out="target", last_row="drop")
    return spl.holdout(d, 0.2).drop("_i").checkpoint()


def _scored_out(df):
    return df.select(*KEYS, TS, "pred", rounded("prob").alias("prob"))


@query("f5_gbt_train_score")
def f5_gbt_train_score(spark, sf):
    """Boosted trees on the training rows, class and P(up) on the test rows."""
    d = model_frame(spark, sf)
    model = ml.gbt_model(FEATURES, "target", **GBT).fit(d.filter(F.col("split") == "train"))
    return _scored_out(ml.score(model, d.filter(F.col("split") == "test"), keep=[*KEYS, TS]))


@query("f6_score_latest")
def f6_score_latest(spark, sf):
    """The live form: score only the latest bar of every series."""
    d = model_frame(spark, sf)
    model = ml.gbt_model(FEATURES, "target", **GBT).fit(d.filter(F.col("split") == "train"))
    last = latest_per_series(d)
    return _scored_out(ml.score(model, last, keep=[*KEYS, TS]))


_F7_SQL = f"""{_D4_SQL},
n AS (SELECT *, row_number() OVER ({q.ORDER}) - 1 AS i, count(*) OVER ({q.SERIES}) AS n FROM l)
SELECT {KEYS_SQL}, label, true AS distribution, true AS likeliest, true AS gains FROM n WHERE i >= floor(n * 0.8) AND timeframe = '1h'"""


def _ternary(spark, sf):
    ensure_checkpoint_dir(spark)
    d = lab.ternary_label(indicators(event_bars(spark, sf)).drop("_i")).checkpoint()  # hourly bars; the label and weight tables read it again
    d = lab.class_weights(lab.encode_labels(d), out="weight")
    return spl.holdout(d, 0.2).drop("_i")


@query("f7_multiclass_forest")
def f7_multiclass_forest(spark, sf):
    """Ternary labels (D4) indexed (D5), balanced weights (D6), weighted
    random forest; predicted class mapped back to -1/0/1."""
    d = _ternary(spark, sf)
    model = ml.forest_model(FEATURES, "label_idx", "weight", numTrees=20, maxDepth=5).fit(d.filter(F.col("split") == "train"))
    s = model.transform(d.filter(F.col("split") == "test"))
    classes = d.select("label", "label_idx").distinct()
    s = s.join(F.broadcast(classes.withColumnRenamed("label", "pred_label").withColumnRenamed("label_idx", "prediction_idx")),
               F.col("prediction").cast("int") == F.col("prediction_idx"), "left")
    return s.select(*KEYS, TS, "label", F.col("pred_label").alias("pred"))


@query("f7_multiclass_boosted", _F7_SQL)
def f7_multiclass_boosted(spark, sf):
    """The same rows through weighted softmax boosting: one row per test row, whether its
    probabilities are a distribution and its prediction their maximum, and whether
    the model gains on the weighted prior (the mean weighted log loss of the training rows
    is below that of the class shares)."""
    d = _ternary(spark, sf).checkpoint()
    train = d.where("split = 'train'")
    model = boosting.fit_boosted(train, FEATURES, "label_idx", 3, "weight", rounds=3)
    loss = lambda p: F.avg(F.col("weight") * -F.log(F.element_at(p, F.col("label_idx") + 1)))
    prior = boosting.BoostedClasses(FEATURES, model.start, [], model.step)
    fitted, flat = (m.transform(train).agg(loss(F.col("probability"))).first()[0] for m in (model, prior))
    p = F.col("probability")
    fair = (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9) & F.forall(p, lambda x: x.between(0, 1))
    s = model.transform(d.where("split = 'test'"))
    return s.select(*KEYS, TS, "label", fair.alias("distribution"), (F.element_at(p, F.col("prediction") + 1) == F.array_max(p)).alias("likeliest"), F.lit(fitted < flat).alias("gains"))


@query("f8_gbt_validation")
def f8_gbt_validation(spark, sf):
    """Row and feature subsampling plus early stopping on the last 10 % of
    each series' training rows (``validationIndicatorCol``)."""
    d = model_frame(spark, sf)
    tr = ml.chronological_validation(d, 0.1)
    model = ml.gbt_model(
        FEATURES, "target", maxIter=60, maxDepth=4, stepSize=0.1, subsamplingRate=0.8,
        featureSubsetStrategy="sqrt", validationIndicatorCol="is_val", validationTol=0.01,
    ).fit(tr)
    s = ml.score(model, d.filter(F.col("split") == "test"), keep=[*KEYS, TS])
    return _scored_out(s).withColumn("trees", F.lit(model.stages[-1].getNumTrees))


@query(
    "f9_validation_rows",
    f"""WITH {bars_cte('1h')}, n AS (SELECT *, row_number() OVER ({q.ORDER}) - 1 AS i, count(*) OVER ({q.SERIES}) AS n FROM bars),
t AS (SELECT *, floor(n * CAST(0.8 AS DOUBLE)) AS m FROM n)
SELECT {KEYS_SQL}, i >= floor(m * CAST(0.9 AS DOUBLE)) AS is_val FROM t WHERE i < m""",
)
def f9_validation_rows(spark, sf):
    """The rows that early stopping watches: the last tenth of each series' training rows."""
    d = ml.chronological_validation(spl.holdout(event_bars(spark, sf), 0.2), 0.1)
    return d.select(*KEYS, TS, "is_val")


@query("f10_scaled_logistic")
def f10_scaled_logistic(spark, sf):
    d = model_frame(spark, sf)
    model = ml.logistic_model(FEATURES, "target", maxIter=50, regParam=0.01).fit(d.filter(F.col("split") == "train"))
    return _scored_out(ml.score(model, d.filter(F.col("split") == "test"), keep=[*KEYS, TS]))


@query("f11_random_search")
def f11_random_search(spark, sf):
    """Three random trials over three expanding time-series folds per series."""
    ensure_checkpoint_dir(spark)
    d = indicators(event_bars(spark, sf)).drop("_i")
    d = lab.next_bar_up(d, out="target", last_row="drop").drop("_i")
    folds = spl.time_series_folds(d, 3).drop("_i")
    return ml.random_search(spark, folds, FEATURES, "target", trials=3, space={"maxDepth": ("int", 2, 5), "stepSize": ("log", 0.03, 0.3), "maxIter": ("int", 5, 20)})


@query("f12_self_training")
def f12_self_training(spark, sf):
    """Fit on train, pseudo-label confident test rows (P >= 0.7), refit."""
    d = model_frame(spark, sf)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    model, n = ml.self_train(train, test.drop("target"), FEATURES, "target", 0.7, 10, **GBT)
    return _scored_out(ml.score(model, test, keep=[*KEYS, TS])).withColumn("pseudo_labels", F.lit(n))


@query("f13_soft_vote")
def f13_soft_vote(spark, sf):
    """Soft vote of boosted trees and a random forest."""
    d = model_frame(spark, sf)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    m1 = ml.gbt_model(FEATURES, "target", **GBT).fit(train)
    m2 = ml.forest_model(FEATURES, "target", numTrees=20, maxDepth=5).fit(train)
    return _scored_out(ml.soft_vote([m1, m2], test, keep=[*KEYS, TS]))


@query("f15_model_registry")
def f15_model_registry(spark, sf):
    """Save a model with its ordered feature list, load it back by name from
    the registry table, align the features and score."""
    d = model_frame(spark, sf)
    model = ml.gbt_model(FEATURES, "target", **GBT).fit(d.filter(F.col("split") == "train"))
    root = scratch(spark, "f15")
    ml.register_model(spark, model, "gbt_1h", FEATURES, root + "/registry", root + "/models")
    loaded, feats = ml.load_registered(spark, root + "/registry", "gbt_1h")
    test = ml.align_for_model(d.filter(F.col("split") == "test"), feats, keep=[*KEYS, TS])
    return _scored_out(ml.score(loaded, test, keep=[*KEYS, TS]))


@query(
    "f16_stale_models",
    """WITH reg AS (SELECT 'model_' || CAST(o_custkey AS VARCHAR) AS name, o_orderdate AS saved_at FROM orders),
latest AS (SELECT name, max(saved_at) AS saved_at FROM reg GROUP BY name),
run AS (SELECT max(o_orderdate) AS t FROM orders)
SELECT name, saved_at FROM latest JOIN run ON true WHERE date_diff('day', CAST(saved_at AS DATE), CAST(t AS DATE)) > 7""",
)
def f16_stale_models(spark, sf):
    """Registry = orders (one model per customer, saved at each order date);
    models whose latest save is more than 7 days before the newest order."""
    o = table(spark, sf, "orders")
    reg = o.select(F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"), F.col("o_orderdate").alias("saved_at"))
    # The run date is one aggregate row, attached by a constant-key equi-join.
    as_of = o.agg(F.max("o_orderdate").alias("t")).withColumn("_k", F.lit(0))
    j = reg.withColumn("_k", F.lit(0)).join(F.broadcast(as_of), "_k")
    return ml.stale_models(j, F.col("t"), 7).select("name", "saved_at")


@query("g7_feature_importance")
def g7_feature_importance(spark, sf):
    d = model_frame(spark, sf)
    model = ml.gbt_model(FEATURES, "target", **GBT).fit(d.filter(F.col("split") == "train"))
    return ml.feature_importance(model, FEATURES, spark, 20).select("feature", rounded("importance").alias("importance"))
