"""Full-batch gradient descent with a step of step / sqrt(i): the same weights on every run and file layout."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.operators.learning import error_rate, mean_squared_error
from varloom.session import stage

LOSSES = ("squared", "hinge", "logistic")


def margin(weights: Sequence[float], features: Sequence[str]) -> Column:
    """Weighted sum of the features, added in their order."""
    return reduce(lambda a, b: a + b, [F.lit(w) * F.col(f) for w, f in zip(weights, features, strict=True)])


def _slope(loss: str, label: Column, dot: Column) -> Column:
    """What a row's features are multiplied with in the gradient. Labels are 0 or 1 for the classifiers."""
    if loss == "squared":
        return dot - label
    if loss == "logistic":
        return 1 / (1 + F.exp(-dot)) - label
    sign = 2 * label - 1
    return F.when(1 - sign * dot > 0, -sign).otherwise(F.lit(0.0))


def squared_sums(df: DataFrame, features: Sequence[str], label: str = "label") -> tuple[list[list[float]], list[float], int]:
    """Products of features with each other and with the label, and the number of rows, in one pass with partial sums."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    sums = [F.sum(F.col(a) * F.col(b)) for a, b in pairs] + [F.sum(F.col(a) * F.col(label)) for a in features]
    *values, n = df.agg(*[F.coalesce(s, F.lit(0.0)) for s in sums], F.count(F.lit(1))).first()
    at = {p: v for p, v in zip(pairs, values)}
    gram = [[at.get((a, b), at.get((b, a))) for b in features] for a in features]
    return gram, values[len(pairs) :], n


def gradient_descent(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    loss: str = "squared",
    step: float = 1.0,
    iterations: int = 100,
    penalty: float = 0.0,
) -> list[float]:
    """Weights after ``iterations`` steps from zero, without intercept.

    Step i goes down the mean gradient by step / sqrt(i), after the weights have shrunk by (1 - step / sqrt(i) x penalty). Rows
    with a null label or feature take no part; an empty table leaves the weights at zero. The gradient of the squared
    loss is linear in the weights, so the sums of products are taken in one pass and the steps follow from them. The other
    losses take one aggregate with partial sums per step over the staged rows. Only one number per feature, or per
    pair of features, reaches the driver.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    rows = df.select(F.col(label).cast("double").alias("__label"), *[F.col(f).cast("double") for f in features]).na.drop()
    weights = [0.0] * len(features)
    if loss == "squared":
        gram, moment, n = squared_sums(rows, features, "__label")

        def gradient(w):
            return [(sum(g * x for g, x in zip(row, w)) - m) / n for row, m in zip(gram, moment)]
    else:
        rows = stage(rows, "descent")
        n = rows.count()

        def gradient(w):
            slope = _slope(loss, F.col("__label"), margin(w, features))
            return [s / n for s in rows.withColumn("__slope", slope).agg(*[F.sum(F.col("__slope") * F.col(f)) for f in features]).first()]

    for i in range(1, iterations + 1 if n else 1):
        size = step / math.sqrt(i)
        weights = [w * (1 - size * penalty) - size * g for w, g in zip(weights, gradient(weights))]
    return weights


def train_linear_descent(df: DataFrame, features: Sequence[str], step: float = 0.1, iterations: int = 100, **options) -> list[float]:
    """Least squares with the given step."""
    return gradient_descent(df, features, loss="squared", step=step, iterations=iterations, **options)


def train_svm_descent(df: DataFrame, features: Sequence[str], iterations: int = 100, penalty: float = 0.01, **options) -> list[float]:
    """Linear support-vector machine: hinge loss with a squared penalty."""
    return gradient_descent(df, features, loss="hinge", iterations=iterations, penalty=penalty, **options)


def train_logistic_descent(df: DataFrame, features: Sequence[str], iterations: int = 100, **options) -> list[float]:
    """Logistic regression."""
    return gradient_descent(df, features, loss="logistic", iterations=iterations, **options)


def predicted(df: DataFrame, weights: Sequence[float], features: Sequence[str], threshold: float | None = None) -> DataFrame:
    """Rows with ``prediction``: the weighted sum, or 1 where it is over the threshold and else 0."""
    dot = margin(weights, features)
    return df.withColumn("prediction", dot if threshold is None else F.when(dot > threshold, 1.0).otherwise(0.0))


#: Trainer, threshold of the weighted sum for class 1, and measure: the linear model is judged by squared error.
DESCENTS = {
    "svm": (train_svm_descent, 0.0, error_rate),
    "linear": (train_linear_descent, None, mean_squared_error),
    "logistic": (train_logistic_descent, 0.0, error_rate),
}


def compare_descents(train: DataFrame, test: DataFrame, features: Sequence[str], iterations: int = 100) -> DataFrame:
    """(model, metric, value) of the three models trained by descent on ``train`` and measured on ``test``."""
    rows = []
    for name, (trainer, threshold, measure) in DESCENTS.items():
        scored = measure(predicted(test, trainer(train, features, iterations=iterations), features, threshold))
        metric = scored.columns[0]
        rows.append(scored.select(F.lit(name).alias("model"), F.lit(metric).alias("metric"), F.col(metric).alias("value")))
    return reduce(DataFrame.unionByName, rows)
