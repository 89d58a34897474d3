"""gradient boosting over several classes with row weights.

Softmax boosting in Newton steps: every round fits one weighted regression tree
(``DecisionTreeRegressor``) per class to ``(y - p) / h`` with weights ``w h``, ``h = p (1 - p)``, so a
leaf holds ``sum w (y - p) / sum w h``.  A fitted tree becomes a nested CASE expression: scores
are plain columns inside code generation, whatever the number of trees.  The margins of
the training rows are written to the shared checkpoint folder after every round, so no
round replays earlier ones.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.operators.ml import assembler
from tickweave.session import ensure_checkpoint_dir

LEAST_H = 1e-3  # bounds a row's Newton target
FAR = sys.float_info.max  # stands for a missing value while a tree is fitted: right of every threshold


def finite(c: str) -> Column:
    """The feature for the tree learner, which takes finite numbers only."""
    x = F.nanvl(F.col(c).cast("double"), F.lit(FAR))
    return F.coalesce(F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(FAR)), F.lit(-FAR))), F.lit(FAR))


def tree_of(model: DecisionTreeRegressionModel) -> list | float:
    """A fitted tree as nested [feature, threshold, left, right] lists with leaf values."""

    def walk(node) -> list | float:
        if node.getClass().getSimpleName() == "LeafNode":
            return node.prediction()
        split = node.split()
        return [split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())]

    return walk(model._java_obj.rootNode())


def tree_value(tree: list | float, features: Sequence[str]) -> Column:
    """The tree as an expression (a null or NaN goes right, as while fitting)."""
    if not isinstance(tree, list):
        return F.lit(float(tree))
    i, threshold, left, right = tree
    return F.when(F.col(features[i]).cast("double") <= F.lit(threshold), tree_value(left, features)).otherwise(tree_value(right, features))


def softmax(margins: Sequence[Column]) -> list[Column]:
    top = F.greatest(*margins)
    e = [F.exp(m - top) for m in margins]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


@dataclass
class BoostedClasses:
    """A fitted model: starting margins, and per round one tree per class."""

    features: list[str]
    start: list[float]
    rounds: list[list]
    step: float

    def margins(self) -> list[Column]:
        return [sum((F.lit(self.step) * tree_value(r[k], self.features) for r in self.rounds), F.lit(s)) for k, s in enumerate(self.start)]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability array<double>`` (one per class, summing to 1) and
        ``prediction int`` (the likeliest class, ties to the smaller number)."""
        p = F.array(*softmax([F.col(f"_m{k}") for k in range(len(self.start))]))
        d = df.select("*", *[m.alias(f"_m{k}") for k, m in enumerate(self.margins())]).withColumn("probability", p)
        d = d.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("int"))
        return d.drop(*[f"_m{k}" for k in range(len(self.start))])

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(self.__dict__),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedClasses":
        return BoostedClasses(**json.loads(spark.read.text(path).first()["value"]))


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, classes: int, weight: str | None = None, rounds: int = 10, depth: int = 3, step: float = 0.3, **tree) -> BoostedClasses:
    """Fits ``rounds`` rounds on rows with a ``label`` 0 .. classes-1 (others are left out).
    Missing feature values (null, NaN) take the right branch of a split.

    ``weight``: a non-negative column (D6's class weights); None counts every row once.
    ``tree``: further settings of ``DecisionTreeRegressor`` (e.g. ``minInstancesPerNode``).
    Margins start at the logarithm of the classes' weighted shares (a class without rows
    at the share of half a row).
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    features = list(features)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = train.where(F.col(label).between(0, classes - 1)).select(*[finite(c).alias(c) for c in features], F.col(label).cast("int").alias("_y"), w.alias("_w"))
    rows = assembler(features, "_x").transform(rows).select("_x", *features, "_y", "_w").checkpoint()
    share = {r["_y"]: (r["w"], r["n"]) for r in rows.groupBy("_y").agg(F.sum("_w").alias("w"), F.count("*").alias("n")).collect()}  # a row per class
    if not share:
        raise ValueError("fit_boosted: no row has a label")
    total, n = sum(x for x, _ in share.values()), sum(x for _, x in share.values())
    start = [math.log(max(share.get(k, (0.0, 0))[0] / total, 0.5 / n)) for k in range(classes)]
    model = BoostedClasses(features, start, [], step)
    rows = rows.select("*", *[F.lit(s).alias(f"_m{k}") for k, s in enumerate(start)])
    for _ in range(rounds):
        p = softmax([F.col(f"_m{k}") for k in range(classes)])
        trees = []
        for k in range(classes):
            h = F.greatest(p[k] * (1 - p[k]), F.lit(LEAST_H))
            target = rows.select("_x", (((F.col("_y") == k).cast("double") - p[k]) / h).alias("_t"), (F.col("_w") * h).alias("_h"))
            trees.append(tree_of(DecisionTreeRegressor(featuresCol="_x", labelCol="_t", weightCol="_h", maxDepth=depth, seed=42, **tree).fit(target)))
        model.rounds.append(trees)
        moved = {f"_m{k}": F.col(f"_m{k}") + F.lit(step) * tree_value(t, features) for k, t in enumerate(trees)}
        rows = rows.withColumns(moved).checkpoint()
    return model
