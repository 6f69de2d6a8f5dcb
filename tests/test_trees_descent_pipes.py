"""Interval tree against the plain join, descent against plain loops, chains of processes and how they end."""

from __future__ import annotations

import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from varloom.operators import descent as D
from varloom.operators import effects as E
from varloom.operators import interval_tree as I
from varloom.operators.ranges import range_join

# --- interval tree --------------------------------------------------------------------------------------------------


def some_points(spark, rng, n, parts=3):
    made = [(i, rng.choice(["1", "2", "X", "no"]), rng.randrange(0, 3000)) for i in range(n)]
    made += [(n + 1, None, 5), (n + 2, "1", None), (n + 3, "1", 1500), (n + 3, "1", 1500)]
    return spark.createDataFrame(made, "id int, chrom string, pos int").repartition(parts)


def some_intervals(spark, rng, n):
    """Nested, equal, empty, single and whole-chromosome intervals."""
    made = []
    for i in range(n):
        lo = rng.randrange(0, 3000)
        made.append((rng.choice(["1", "2", "X"]), lo, lo + rng.choice([-1, 0, 1, 5, 60, 900]), f"i{i}"))
    made += [(c, 0, 3000, "whole") for c in "12X"] + [("1", 1400, 1600, "same")] * 3 + [("1", k, 3000 - k, f"nest{k}") for k in range(0, 1500, 50)]
    made += [(None, 0, 3000, "none"), ("1", None, 9, "open"), ("1", 9, None, "open")]
    return spark.createDataFrame(made, "chrom string, start int, stop int, name string")


def plain(points, intervals, how, shift=0, pad=0):
    i = intervals.select(F.col("chrom").alias("c"), "start", "stop", "name")
    inside = (F.col("chrom") == F.col("c")) & F.col("pos").between(F.col("start") + shift - pad, F.col("stop") + shift + pad)
    return points.join(i, inside, how).drop("c")


@pytest.mark.parametrize("how", I.HOWS)
@pytest.mark.parametrize("move", [{}, {"shift": 7}, {"pad": 11}])
def test_tree_is_the_plain_join(spark, how, move):
    rng = random.Random(len(how) + sum(move.values()))
    points, intervals = some_points(spark, rng, 120), some_intervals(spark, rng, 60)
    found = I.tree_join(points, intervals, how, **move)
    assert rows(found) == rows(plain(points, intervals, how, **move)) and found.columns == plain(points, intervals, how).columns


def test_tree_and_bins_agree_on_a_larger_table(spark, monkeypatch):
    rng = random.Random(9)
    points, intervals = some_points(spark, rng, 4000), some_intervals(spark, rng, 400)
    want = rows(range_join(points, intervals, "left", width=100).groupBy("name").count())
    assert rows(I.tree_join(points, intervals).groupBy("name").count()) == want
    monkeypatch.setattr(I, "OUT_ROWS", 64)  # results in many small batches
    assert rows(I.tree_join(points, intervals).groupBy("name").count()) == want
    assert rows(I.tree_join(points, intervals, max_bytes=10).groupBy("name").count()) == want  # too large to send: by bins


def test_tree_keeps_each_interval_once_and_moves_no_point(spark):
    rng = random.Random(4)
    points, intervals = some_points(spark, rng, 50, 1), some_intervals(spark, rng, 20)
    plan = I.tree_join(points, intervals)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and plan.count("Exchange") == 1  # the test's own repartition
    assert "Generate" in range_join(points, intervals, strategy="shuffle_merge")._jdf.queryExecution().executedPlan().toString()


def test_tree_of_nothing(spark):
    rng = random.Random(4)
    points, intervals = some_points(spark, rng, 10), some_intervals(spark, rng, 5)
    assert I.tree_join(points, intervals.limit(0), "inner").count() == 0
    assert I.tree_join(points, intervals.limit(0), "left").where("name is null").count() == points.count()
    assert I.tree_join(points.limit(0), intervals).count() == 0
    with pytest.raises(ValueError):
        I.tree_join(points, intervals, "outer")


# --- descent --------------------------------------------------------------------------------------------------------


def loop(x, y, loss, step, iterations, penalty):
    """One row at a time."""
    w = np.zeros(x.shape[1])
    for i in range(1, iterations + 1):
        g = np.zeros(len(w))
        for row, label in zip(x, y):
            dot = sum(a * b for a, b in zip(w, row))
            if loss == "squared":
                slope = dot - label
            elif loss == "logistic":
                slope = 1 / (1 + math.exp(-dot)) - label
            else:
                sign = 2 * label - 1
                slope = -sign if 1 - sign * dot > 0 else 0
            g += slope * row
        size = step / math.sqrt(i)
        w = w * (1 - size * penalty) - size * g / len(x)
    return w


@pytest.mark.parametrize("loss, step, penalty", [("squared", 0.1, 0.0), ("squared", 0.1, 0.05), ("hinge", 1.0, 0.01), ("logistic", 0.5, 0.0)])
def test_descent_is_the_plain_loop(spark, loss, step, penalty):
    rng = random.Random(3)
    made = [(float(rng.random() < 0.4), rng.random() * 2, rng.gauss(0, 1), rng.random() + 1) for _ in range(60)]
    df = spark.createDataFrame(made, "label double, a double, b double, c double")
    x, y = np.array([r[1:] for r in made]), np.array([r[0] for r in made])
    want = loop(x, y, loss, step, 12, penalty)
    for parts in (1, 5):
        got = D.gradient_descent(df.repartition(parts), ["a", "b", "c"], loss=loss, step=step, iterations=12, penalty=penalty)
        assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_descent_of_odd_tables(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 5.0), (0.0, None)], "label double, a double")
    assert D.gradient_descent(df, ["a"], iterations=1) == [1.0]
    for loss in D.LOSSES:
        assert D.gradient_descent(df.limit(0), ["a"], loss=loss) == [0.0]
    with pytest.raises(ValueError):
        D.gradient_descent(df, ["a"], loss="cubic")
    shown = D.predicted(df, [2.0], ["a"], threshold=1.0)
    assert [r.prediction for r in shown.collect()] == [1.0, 1.0, 0.0]
    assert [r.prediction for r in D.predicted(df, [2.0], ["a"]).collect()] == [2.0, 10.0, None]


# --- chains of processes --------------------------------------------------------------------------------------------

LINE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("word", T.StringType())])


def numbered(spark, n, parts=2):
    return spark.range(n).select(F.col("id").cast("int").alias("n"), F.lit("a").alias("word")).repartition(parts)


def alive(mark):
    found = []
    for pid in filter(str.isdigit, os.listdir("/proc")):
        try:
            with open(f"/proc/{pid}/cmdline") as f:
                words = f.read().split("\0")
        except OSError:
            continue
        found += [pid] if words[0] == "sleep" and mark in words else []
    return found


def test_chain_of_three(spark):
    df = numbered(spark, 5000)
    out = E.pipe_chain(df, ["sed /9$/d", "sed s/a$/b/", "sed /^#/d"], LINE)
    assert out.count() == 5000 and out.where("word = 'b'").count() == 5000
    assert E.pipe_chain(df, ["sed /7.a/d", "sed s/a/b/"], LINE).count() == 4500
    assert E.pipe_chain(df.limit(0), ["cat", "cat"], LINE).count() == 0
    with pytest.raises(ValueError):
        E.pipe_chain(df, [], LINE)


def test_chain_holds_back_a_fast_producer(spark):
    """Far more text than pipes hold passes through a slow last program."""
    df = spark.range(200_000).select(F.col("id").cast("int").alias("n"), F.lit("x" * 60).alias("word")).coalesce(1)
    out = E.pipe_chain(df, ["cat", "cat", "sh -c 'sleep 1; cat'"], LINE)
    assert out.agg(F.count("n"), F.sum("n")).first() == (200_000, sum(range(200_000)))


def test_failing_program_fails_the_task_with_its_words(spark):
    df = numbered(spark, 100_000)
    with pytest.raises(Exception, match="exit status 3: no luck"):
        E.pipe_chain(df, ["cat", "sh -c 'echo no luck >&2; exit 3'", "sleep 61.5"], LINE).count()
    assert alive("61.5") == []


def test_early_end_of_a_reader_is_no_failure(spark):
    out = E.pipe_chain(numbered(spark, 100_000, 1), ["cat", "head -n 10"], LINE)
    assert out.count() == 10


def test_time_limit_ends_every_process(spark):
    began = time.time()
    with pytest.raises(Exception, match="more than 1"):
        E.pipe_chain(numbered(spark, 10, 1), ["cat", "sleep 62.5", "cat"], LINE, timeout=1).count()
    assert time.time() - began < 40 and alive("62.5") == []
