"""Feature scaling and classifiers, on pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.session import stage


def assemble(df: DataFrame, features: Sequence[str], label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """(label, features vector) from numeric columns, and the columns to ``keep``, such as a row key."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    return vector.transform(df).select(F.col(label).cast("double").alias("label"), "features", *keep)


def labelled_points(lines: DataFrame) -> DataFrame:
    """(label, features vector) from number arrays whose first element is the label."""
    values = F.col("values")
    return lines.select(
        F.get(values, F.lit(0)).alias("label"),
        array_to_vector(F.slice(values, F.lit(2), F.size(values) - 1)).alias("features"),
    )


def scale_features(df: DataFrame, with_std: bool = True, with_mean: bool = False) -> DataFrame:
    """Features with unit sample standard deviation; centred only if asked."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withStd=with_std, withMean=with_mean)
    scaled = scaler.fit(df).transform(df)
    return scaled.drop("features").withColumnRenamed("scaled", "features")


def features_to_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Label and one plain column per feature."""
    values = vector_to_array("features")
    return df.select("label", *[F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)])


def split_data(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 7, key: Sequence[str] | None = None
) -> list[DataFrame]:
    """Random train and test parts by a hash of the row key and the seed.

    A row's part depends on nothing else, so another file layout or cluster gives the same split. Without a ``key`` the
    label and the features are hashed; equal rows then share a part.
    """
    return _parts(df, _draw(key, seed), weights)


def _draw(key: Sequence[str] | None, seed: int) -> Column:
    if key is None:
        values = F.transform(vector_to_array("features"), lambda x: x.cast("string"))
        parts = [F.col("label").cast("string"), F.array_join(values, ",")]
    else:
        parts = [F.col(c).cast("string") for c in key]
    return F.substring(F.md5(F.concat_ws("-", *parts, F.lit(str(seed))).cast("binary")), 1, 8)


def _parts(df: DataFrame, draw: Column, weights: Sequence[float]) -> list[DataFrame]:
    edges = [f"{round(sum(weights[:i]) / sum(weights) * (1 << 32)):08x}" for i in range(len(weights))] + ["g"]
    return [df.where((draw >= lo) & (draw < hi)) for lo, hi in zip(edges, edges[1:])]


def stage_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 7, key: Sequence[str] | None = None
) -> list[DataFrame]:
    """Parts for trainers that read their data many times: the rows are stored first, each with its draw, so the input and the
    hashes are computed once."""
    stored = stage(df.withColumn("__draw", _draw(key, seed)), "split")
    return [part.drop("__draw") for part in _parts(stored, F.col("__draw"), weights)]


def train_svm(train: DataFrame, iterations: int = 100) -> Model:
    return LinearSVC(maxIter=iterations).fit(train)


def train_linear(train: DataFrame, iterations: int = 100) -> Model:
    """Least squares; solved by quasi-Newton steps, which choose their own length."""
    return LinearRegression(maxIter=iterations, solver="l-bfgs").fit(train)


def train_logistic(train: DataFrame, iterations: int = 100) -> Model:
    return LogisticRegression(maxIter=iterations).fit(train)


def train_naive_bayes(train: DataFrame, smoothing: float = 1.0) -> Model:
    """Multinomial naive Bayes; features must not be negative."""
    return NaiveBayes(smoothing=smoothing).fit(train)


def train_forest(train: DataFrame, trees: int = 3, depth: int = 4, bins: int = 32, seed: int = 7) -> Model:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=bins, impurity="gini", seed=seed).fit(train)


def mean_squared_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.avg(error * error).alias("mse"))


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction differs from the label."""
    return df.agg(F.avg((F.col(label) != F.col(prediction)).cast("int")).alias("error_rate"))


# Model, trainer and measure of the comparison: the linear and the Bayes model are judged by squared error.
MODELS = {
    "svm": (train_svm, error_rate),
    "linear": (train_linear, mean_squared_error),
    "logistic": (train_logistic, error_rate),
    "naive_bayes": (train_naive_bayes, mean_squared_error),
    "forest": (train_forest, error_rate),
}


def evaluate(name: str, train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, metric, value) of one model trained on ``train`` and measured on ``test``."""
    trainer, measure = MODELS[name]
    scored = measure(trainer(train).transform(test))
    metric = scored.columns[0]
    return scored.select(F.lit(name).alias("model"), F.lit(metric).alias("metric"), F.col(metric).alias("value"))


def compare_models(
    df: DataFrame,
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = 7,
    models: Sequence[str] = tuple(MODELS),
    key: Sequence[str] | None = None,
) -> DataFrame:
    """One row per model on scaled features."""
    train, test = stage_split(scale_features(df), weights, seed, key)
    return reduce(DataFrame.unionByName, [evaluate(name, train, test) for name in models])
