"""Scaling, splitting and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom.operators import descent as D
from varloom.operators import learning as L

FEATURES = ["f1", "f2", "f3", "f4"]


def _points(t):
    return L.assemble(t("ml_matrix"), FEATURES)


@query(
    "scale_features",
    sql(
        "ml_matrix",
        "SELECT label, " + ", ".join(f"round({f} / stddev_samp({f}) OVER (), 6) AS {f}" for f in FEATURES) + " FROM ml_matrix",
    ),
)
def scale_features(t):
    plain = L.features_to_columns(L.scale_features(_points(t)), FEATURES)
    return plain.select("label", *[F.round(f, 6).alias(f) for f in FEATURES])


PREDICTED = "scored AS (SELECT label, CASE WHEN f3 > 0.04 THEN 1 ELSE 0 END AS prediction FROM ml_matrix)"


def _scored(t):
    return t("ml_matrix").select("label", F.when(F.col("f3") > 0.04, 1.0).otherwise(0.0).alias("prediction"))


@query(
    "mean_squared_error",
    sql("ml_matrix", "SELECT round(avg((label - prediction) * (label - prediction)), 9) AS mse FROM scored", PREDICTED),
)
def mean_squared_error(t):
    return L.mean_squared_error(_scored(t)).select(F.round("mse", 9).alias("mse"))


@query(
    "error_rate",
    sql("ml_matrix", "SELECT round(avg(CAST(label <> prediction AS INT)), 9) AS error_rate FROM scored", PREDICTED),
)
def error_rate(t):
    return L.error_rate(_scored(t)).select(F.round("error_rate", 9).alias("error_rate"))


KEY = ["l_orderkey", "l_linenumber"]
DRAWN = "substr(md5(l_orderkey || '-' || l_linenumber || '-7'), 1, 8)"


def _keyed(t):
    return L.assemble(t("ml_matrix"), FEATURES, keep=KEY)


def _parts(edge: float) -> str:
    """Scaled rows with the part they fall into."""
    scaled = ", ".join(f"{f} / stddev_samp({f}) OVER () AS {f}" for f in FEATURES)
    bound = f"{round(edge * (1 << 32)):08x}"
    return f"parts AS (SELECT label, {scaled}, CASE WHEN {DRAWN} < '{bound}' THEN 'train' ELSE 'test' END AS part FROM ml_matrix)"


@query("split_data", sql("ml_matrix", "SELECT part, count(*) AS n FROM parts GROUP BY part", _parts(0.8)))
def split_data(t):
    train, test = L.split_data(_keyed(t), (0.8, 0.2), 7, KEY)
    a, b = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("part"), "n") for n, df in (("train", train), ("test", test))]
    return a.unionByName(b)


# What is known of a model without fitting it: the parts, their classes, the error of the best constant, and that it does better.
BASE = {"error_rate": "least(avg(label), 1 - avg(label))", "mse": "avg(label) * (1 - avg(label))"}


def _row(name: str, metric: str) -> str:
    return f"""SELECT '{name}' AS model, '{metric}' AS metric, (SELECT count(*) FROM parts WHERE part = 'train') AS n_train,
        (SELECT CAST(sum(label) AS BIGINT) FROM parts WHERE part = 'train') AS positives, count(*) AS n_test,
        round({BASE[metric]}, 6) AS constant_error, true AS better FROM parts WHERE part = 'test'"""


def _described(evaluated, train, test):
    """Spark's side: sizes, classes and the constant's error from the parts, ``better`` from the fitted model."""
    share = F.avg("label")
    sizes = train.agg(F.count("*").alias("n_train"), F.sum("label").cast("long").alias("positives")).first()
    base = test.agg(
        F.count("*").alias("n_test"), F.least(share, 1 - share).alias("error_rate"), (share * (1 - share)).alias("mse")
    ).first()
    constant = F.when(F.col("metric") == "mse", F.lit(base["mse"])).otherwise(F.lit(base["error_rate"]))
    return evaluated.select(
        "model", "metric", F.lit(sizes["n_train"]).cast("long").alias("n_train"), F.lit(sizes["positives"]).cast("long").alias("positives"),
        F.lit(base["n_test"]).cast("long").alias("n_test"), F.round(constant, 6).alias("constant_error"), (F.col("value") < constant).alias("better"),
    )


def _trained(name: str, metric: str, edge: float = 0.8):
    @query(f"train_{name}", sql("ml_matrix", _row(name, metric), _parts(edge)))
    def run(t):
        train, test = L.stage_split(L.scale_features(_keyed(t)), (edge, 1 - edge), 7, KEY)
        return _described(L.evaluate(name, train, test), train, test)


_trained("svm", "error_rate")
_trained("linear", "mse")
_trained("logistic", "error_rate")
_trained("forest", "error_rate", 0.7)

HINGE = "CASE WHEN 1 - (2 * p.label - 1) * ({dot}) > 0 THEN 1 - 2 * p.label ELSE 0 END"
SLOPES = {"linear": ("{dot} - p.label", 0.1, 0.0), "svm": (HINGE, 1.0, 0.01), "logistic": ("1 / (1 + exp(-({dot}))) - p.label", 1.0, 0.0)}
TRAIN = "train AS MATERIALIZED (SELECT * FROM parts WHERE part = 'train')"


def _steps(model: str, iterations: int = 100, name: str = "steps") -> str:
    """The same steps as a recursion: every step reads all training rows."""
    slope, step, penalty = SLOPES[model]
    dot = " + ".join(f"s.w{i} * p.{f}" for i, f in enumerate(FEATURES, 1))
    means = ", ".join(f"avg(({slope.format(dot=dot)}) * p.{f}) AS g{i}" for i, f in enumerate(FEATURES, 1))
    held = ", ".join(f"s.w{i}" for i in range(1, 5))
    size = f"({step} / sqrt(CAST(i + 1 AS DOUBLE)))"
    moved = ", ".join(f"w{i} * (1 - {size} * {penalty}) - {size} * g{i}" for i in range(1, 5))
    return f"""{name}(i, w1, w2, w3, w4) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
    SELECT i + 1, {moved} FROM (SELECT s.i, {held}, {means} FROM {name} s, train p WHERE s.i < {iterations} GROUP BY s.i, {held}))"""


def _descent(model: str) -> str:
    return ",".join([_parts(0.8), TRAIN, _steps(model)])


WEIGHTS = " UNION ALL ".join(f"SELECT '{f}' AS feature, round(w{i}, 6) AS weight FROM steps WHERE i = 100" for i, f in enumerate(FEATURES, 1))


def _weights(t, train):
    """Trained on the columns of the scaled training part; one row per feature."""
    part, _ = L.stage_split(L.scale_features(_keyed(t)), (0.8, 0.2), 7, KEY)
    weights = train(L.features_to_columns(part, FEATURES), FEATURES)
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).alias("weight")) for f, w in zip(FEATURES, weights, strict=True)]))
    return t.spark.range(1).select(values.alias("x")).select("x.feature", F.round("x.weight", 6).alias("weight"))


@query("train_linear_descent", sql("ml_matrix", WEIGHTS, _descent("linear"), recursive=True))
def train_linear_descent(t):
    return _weights(t, D.train_linear_descent)


@query("train_svm_descent", sql("ml_matrix", WEIGHTS, _descent("svm"), recursive=True))
def train_svm_descent(t):
    return _weights(t, D.train_svm_descent)


# Multinomial naive Bayes in closed form: smoothed log shares of each feature's sum in a class.
_sums = ", ".join(f"sum({f}) AS s{i}" for i, f in enumerate(FEATURES, 1))
_all = " + ".join(f"s{i}" for i in range(1, 5))
_theta = ", ".join(f"ln(s{i} + 1) - ln({_all} + 4) AS t{i}" for i in range(1, 5))
_likely = " + ".join(f"p.{f} * m.t{i}" for i, f in enumerate(FEATURES, 1))
BAYES = f"""{_parts(0.8)},
  sums AS (SELECT label, count(*) AS n, {_sums} FROM parts WHERE part = 'train' GROUP BY label),
  model AS (SELECT label, ln(n + 1) - ln(sum(n) OVER () + count(*) OVER ()) AS prior, {_theta} FROM sums),
  tests AS (SELECT *, row_number() OVER () AS id FROM parts WHERE part = 'test'),
  guesses AS (SELECT p.id, p.label, arg_max(m.label, m.prior + {_likely}) AS guess FROM tests p CROSS JOIN model m GROUP BY p.id, p.label)"""


@query(
    "train_naive_bayes",
    sql(
        "ml_matrix",
        "SELECT 'naive_bayes' AS model, 'mse' AS metric, round(avg((label - guess) * (label - guess)), 6) AS value FROM guesses",
        BAYES,
    ),
)
def train_naive_bayes(t):
    train, test = L.stage_split(L.scale_features(_keyed(t)), (0.8, 0.2), 7, KEY)
    return L.evaluate("naive_bayes", train, test).withColumn("value", F.round("value", 6))


COMPARED = {"svm": "error_rate", "linear": "mse", "logistic": "error_rate", "forest": "error_rate"}


@query("compare_models", sql("ml_matrix", " UNION ALL ".join(_row(n, m) for n, m in COMPARED.items()), _parts(0.8)))
def compare_models(t):
    train, test = L.split_data(L.scale_features(_keyed(t)), (0.8, 0.2), 7, KEY)
    return _described(L.compare_models(_keyed(t), models=tuple(COMPARED), key=KEY), train, test)


COMPARE_STEPS = 20
_dot = " + ".join(f"s.w{i} * p.{f}" for i, f in enumerate(FEATURES, 1))


def _error(model: str) -> str:
    guess = f"CASE WHEN {_dot} > 0 THEN 1 ELSE 0 END"
    wrong = f"(p.label - ({_dot})) * (p.label - ({_dot}))" if model == "linear" else f"CAST(p.label <> {guess} AS INT)"
    return f"""SELECT '{model}' AS model, '{'mse' if model == 'linear' else 'error_rate'}' AS metric, round(avg({wrong}), 6) AS value
        FROM {model}_steps s, parts p WHERE s.i = {COMPARE_STEPS} AND p.part = 'test'"""


@query(
    "compare_descents",
    sql(
        "ml_matrix",
        " UNION ALL ".join(
            [*[_error(m) for m in SLOPES], "SELECT 'naive_bayes', 'mse', round(avg((label - guess) * (label - guess)), 6) FROM guesses"]
        ),
        ",".join([BAYES, TRAIN, *[_steps(m, COMPARE_STEPS, f"{m}_steps") for m in SLOPES]]),
        recursive=True,
    ),
)
def compare_descents(t):
    """The four models of the comparison, every error worked out on both sides: three by descent, one in closed form."""
    train, test = L.stage_split(L.scale_features(_keyed(t)), (0.8, 0.2), 7, KEY)
    bayes = L.evaluate("naive_bayes", train, test)
    columns = [L.features_to_columns(part, FEATURES) for part in (train, test)]
    return D.compare_descents(*columns, FEATURES, COMPARE_STEPS).unionByName(bayes).withColumn("value", F.round("value", 6))
