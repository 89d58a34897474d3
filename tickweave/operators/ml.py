"""Model training, scoring, search and registry on Spark ML.

The reference used LightGBM / XGBoost / scikit-learn / Optuna on one machine;
here every fit is a ``pyspark.ml`` estimator over a distributed DataFrame.
Hyper-parameter search draws parameters on the driver (a handful of numbers)
and runs each fold as a Spark job; the fold data is checkpointed once to the
shared checkpoint folder so repeated fits do not replay the feature plan.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.clean import align_features


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def gbt_model(features: Sequence[str], label: str = "target", scale: bool = False, **params) -> Pipeline:
    """Assembler (+ F10 scaler) + gradient-boosted trees.

    ``params`` go to ``GBTClassifier`` (e.g. ``maxIter``, ``maxDepth``,
    ``stepSize``, ``subsamplingRate``, ``featureSubsetStrategy``,
    ``validationIndicatorCol``, ``validationTol`` for early stopping).
    """
    stages = [assembler(features, "raw_features" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    stages.append(GBTClassifier(featuresCol="features", labelCol=label, seed=42, **params))
    return Pipeline(stages=stages)


def forest_model(features: Sequence[str], label: str = "label_idx", weight: str | None = None, **params) -> Pipeline:
    """multiclass random forest with per-row weights (``weightCol``)."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, seed=42, **params)
    if weight:
        rf = rf.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), rf])


def logistic_model(features: Sequence[str], label: str = "target", **params) -> Pipeline:
    """standardised features + logistic regression."""
    return Pipeline(
        stages=[
            assembler(features, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(featuresCol="features", labelCol=label, **params),
        ]
    )


def p_up(prob_col: str = "probability", cls: int = 1) -> Column:
    """P(class) from the probability vector."""
    return vector_to_array(F.col(prob_col))[cls]


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (), prob_name: str = "prob", pred_name: str = "pred") -> DataFrame:
    """class and P(up) for every row (``keep`` columns carried along).
    Models without probabilities give 1.0 / 0.0 from the class."""
    out = model.transform(df)
    has_prob = "probability" in out.columns
    prob = p_up() if has_prob else F.col("prediction").cast("double")
    return out.select(*keep, F.col("prediction").cast("int").alias(pred_name), prob.alias(prob_name))


def chronological_validation(df: DataFrame, ratio: float = 0.1, split_col: str = "split", out: str = "is_val") -> DataFrame:
    """mark the last ``ratio`` of the training rows of each series as the
    early-stopping validation set (uses F1's per-series holdout)."""
    from tickweave.operators.splits import holdout

    tr = df.filter(F.col(split_col) == "train").drop(split_col)
    tr = holdout(tr, ratio, out="_v")
    return tr.withColumn(out, F.col("_v") == "test").drop("_v")


def feature_importance(model: PipelineModel, features: Sequence[str], spark: SparkSession, top: int = 20) -> DataFrame:
    """The last stage's feature importances as rows, top ``top``.

    The vector has one entry per feature (a few dozen numbers), so it is
    brought to the driver and turned into a small DataFrame.
    """
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def accuracy_of(scored: DataFrame, label: str, pred: str = "pred") -> float:
    return scored.agg(F.avg((F.col(label) == F.col(pred)).cast("double"))).first()[0] or 0.0


def random_search(
    spark: SparkSession,
    folds: DataFrame,
    features: Sequence[str],
    label: str = "target",
    trials: int = 20,
    seed: int = 42,
    space: dict | None = None,
) -> DataFrame:
    """random search with expanding-window folds (``walk_forward`` or
    ``time_series_folds`` output: ``fold``, ``role``); mean fold accuracy per
    trial.  ``CrossValidator`` trains on all other folds, which would leak the
    future, so folds are looped here.

    ``space``: name -> ("int"|"uniform"|"log", low, high).  The fold table is
    checkpointed once (reliable checkpoint in the shared folder) so that the
    ``trials x folds`` fits read it instead of replaying its plan.
    """
    space = space or {
        "maxDepth": ("int", 2, 6),
        "stepSize": ("log", 0.01, 0.3),
        "subsamplingRate": ("uniform", 0.5, 1.0),
        "maxIter": ("int", 10, 40),
    }
    rng = random.Random(seed)
    data = folds.checkpoint(eager=True)
    fold_ids = [r[0] for r in data.select("fold").distinct().orderBy("fold").collect()]
    results = []
    for t in range(trials):
        params = {}
        for name, (kind, lo, hi) in space.items():
            if kind == "int":
                params[name] = rng.randint(lo, hi)
            elif kind == "log":
                params[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                params[name] = rng.uniform(lo, hi)
        accs = []
        for f in fold_ids:
            part = data.filter(F.col("fold") == f)
            model = gbt_model(features, label, **params).fit(part.filter(F.col("role") == "train"))
            accs.append(accuracy_of(score(model, part.filter(F.col("role") == "test"), keep=[label]), label))
        results.append((t, str(sorted(params.items())), float(sum(accs) / len(accs)) if accs else None, len(accs)))
    return spark.createDataFrame(results, "trial int, params string, mean_accuracy double, folds int")


def self_train(
    train: DataFrame,
    unlabeled: DataFrame,
    features: Sequence[str],
    label: str = "target",
    threshold: float = 0.7,
    min_rows: int = 10,
    **params,
) -> tuple[PipelineModel, int]:
    """fit, score the unlabeled rows, keep those with P(class) >=
    ``threshold`` as pseudo-labels, refit on train + pseudo-labels when there
    are more than ``min_rows`` of them.  Returns (model, pseudo-label count)."""
    model = gbt_model(features, label, **params).fit(train)
    s = model.transform(unlabeled)
    p1 = p_up()
    conf = F.greatest(p1, F.lit(1.0) - p1)
    pseudo = s.filter(conf >= F.lit(threshold)).select(*features, F.col("prediction").cast("int").alias(label))
    n = pseudo.count()
    if n > min_rows:
        model = gbt_model(features, label, **params).fit(train.select(*features, label).unionByName(pseudo))
    return model, n


def soft_vote(models: Sequence[PipelineModel], df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """mean of the members' P(up); the class is P(up) >= 0.5.

    Members are applied one after another on the same rows (their output
    columns renamed), so no join is needed."""
    d = df
    probs = []
    for k, m in enumerate(models):
        d = m.transform(d)
        d = d.withColumn(f"_p{k}", p_up()).drop("features", "raw_features", "rawPrediction", "probability", "prediction")
        probs.append(F.col(f"_p{k}"))
    avg = probs[0]
    for p in probs[1:]:
        avg = avg + p
    avg = avg / F.lit(float(len(probs)))
    return d.select(*keep, (avg >= 0.5).cast("int").alias("pred"), avg.alias("prob"))


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("saved_at", T.TimestampNTZType()),
        T.StructField("features", T.ArrayType(T.StringType())),
    ]
)


def register_model(spark: SparkSession, model: PipelineModel, name: str, features: Sequence[str], registry_path: str, model_root: str) -> DataFrame:
    """save the model and append (name, path, saved time, ordered
    feature list) to the registry table."""
    path = f"{model_root.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    row = spark.createDataFrame([(name, path, now, list(features))], REGISTRY_SCHEMA)
    row.write.mode("append").parquet(registry_path)
    return row


def load_registered(spark: SparkSession, registry_path: str, name: str) -> tuple[PipelineModel, list[str]]:
    """latest registry entry of ``name`` -> (model, feature list)."""
    reg = spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path).filter(F.col("name") == name)
    last = reg.orderBy(F.col("saved_at").desc()).first()
    return PipelineModel.load(last["path"]), list(last["features"])


def stale_models(registry: DataFrame, as_of: Column, max_age_days: int = 7, saved: str = "saved_at") -> DataFrame:
    """F16: latest entry per model older than ``max_age_days`` (to refit).

    ``as_of`` is a literal or a column of ``registry`` (e.g. a run date joined on)."""
    latest = registry.groupBy("name").agg(F.max(saved).alias(saved), F.max(as_of).alias("_as_of"))
    return latest.filter(F.datediff(F.col("_as_of"), F.col(saved)) > F.lit(max_age_days)).drop("_as_of")


def align_for_model(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """B15 before scoring: the model's feature list in order, missing as 0."""
    return align_features(df, features, keep)
