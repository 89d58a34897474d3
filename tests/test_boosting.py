"""Weighted multiclass boosting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.operators.boosting import BoostedClasses, fit_boosted


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        a, b = rng.normal(size=2)
        y = 0 if a < -0.3 else 1 if b > 0.4 else 2  # what a tree finds
        rows.append((float(a), None if i % 50 == 0 else float(b), y, 1.0))
    rows += [(9.0, 9.0, 1, 0.0)] * 200 + [(0.0, 0.0, None, 1.0), (1.0, math.nan, 2, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y int, w double")
    return df, fit_boosted(df, ["a", "b"], "y", 3, "w", rounds=5, depth=2)


def test_beats_the_majority_class_with_proper_probabilities(fitted):
    df, model = fitted
    out = model.transform(df.where("y is not null and w > 0")).toPandas()
    p = np.array(out["probability"].tolist())
    np.testing.assert_allclose(p.sum(axis=1), 1.0, atol=1e-12)
    assert (out["prediction"] == p.argmax(axis=1)).all()
    assert (out["prediction"] == out["y"]).mean() > 0.9 > out["y"].value_counts(normalize=True).max()


def test_weights_count(spark):
    """Rows that no feature tells apart: the weights decide."""
    df = spark.createDataFrame([(1.0, 0, 1.0)] * 30 + [(1.0, 1, 10.0)] * 10, "x double, y int, w double")
    light = fit_boosted(df, ["x"], "y", 2, None, rounds=2).transform(df).first()
    heavy = fit_boosted(df, ["x"], "y", 2, "w", rounds=2).transform(df).first()
    assert light["prediction"] == 0 and light["probability"][0] == pytest.approx(0.75)
    assert heavy["prediction"] == 1 and heavy["probability"][1] == pytest.approx(100 / 130)


def test_saved_model_is_the_same(spark, fitted, tmp_path):
    df, model = fitted
    model.save(spark, str(tmp_path / "m"))
    again = BoostedClasses.load(spark, str(tmp_path / "m"))
    assert again == model
    one = again.transform(df.where(F.col("w") > 0)).orderBy("a", "b").first()
    assert one["probability"] == model.transform(df.where(F.col("w") > 0)).orderBy("a", "b").first()["probability"]


def test_no_labelled_rows(spark):
    with pytest.raises(ValueError, match="no row"):
        fit_boosted(spark.createDataFrame([(1.0, None)], "x double, y int"), ["x"], "y", 2)
