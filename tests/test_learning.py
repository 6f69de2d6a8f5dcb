"""Scaling and classifiers on separable data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators import learning as L


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(0, 400, 1, 4).select(
        (F.col("id") % 2).cast("double").alias("label"),
        ((F.col("id") % 2) * 5 + F.rand(1)).alias("f1"),
        (F.rand(2) * 10).alias("f2"),
    )
    return L.assemble(df, ["f1", "f2"])


def test_scaling(points):
    raw = np.array([r.features.toArray() for r in points.collect()])
    scaled = np.array([r.features.toArray() for r in L.scale_features(points).collect()])
    assert np.allclose(scaled, raw / raw.std(axis=0, ddof=1))
    centred = np.array([r.features.toArray() for r in L.scale_features(points, with_mean=True).collect()])
    assert np.allclose(centred.mean(axis=0), 0)


def test_split_is_whole_and_repeatable(points):
    train, test = L.split_data(points)
    assert train.count() + test.count() == 400
    assert L.split_data(points)[0].count() == train.count()
    assert 0.7 < train.count() / 400 < 0.9


def test_stored_split_is_whole_disjoint_and_repeatable(points):
    numbered = points.withColumn("n", F.monotonically_increasing_id())
    once, twice = [[{r.n for r in part.collect()} for part in L.stage_split(numbered, (7, 2, 1), 3)] for _ in range(2)]
    assert once == twice and len(set.union(*once)) == 400 and sum(map(len, once)) == 400
    assert 0.6 < len(once[0]) / 400 < 0.8 and 0.04 < len(once[2]) / 400 < 0.16


def test_models_learn(points):
    out = {r.model: (r.metric, r.value) for r in L.compare_models(points).collect()}
    assert set(out) == {"svm", "linear", "logistic", "naive_bayes", "forest"}
    assert {m for m, (metric, _) in out.items() if metric == "mse"} == {"linear", "naive_bayes"}
    # Either class is linearly separable; a small forest that draws one feature per node need not find it every time.
    assert out["svm"][1] == out["logistic"][1] == 0 and out["forest"][1] < 0.1
    assert out["linear"][1] < 0.05 and out["naive_bayes"][1] < 0.5
    # Partial float sums merge in task order, so the last digits of an error may differ between runs.
    again = {r.model: (r.metric, pytest.approx(r.value, rel=1e-6)) for r in L.compare_models(points).collect()}
    assert out == again


def test_measures(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.5), (0.0, 0.0)], "label double, prediction double")
    assert L.mean_squared_error(df).collect()[0].mse == pytest.approx((1 + 0.25) / 4)
    assert L.error_rate(df).collect()[0].error_rate == 0.5
