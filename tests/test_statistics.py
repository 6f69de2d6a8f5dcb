"""Allele statistics against plain Python on random cases; each case is a chromosome of its own."""

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from varloom.functions import dosage
from varloom.operators import statistics as A


def greedy(positions, bp):
    kept, last = [], None
    for p in sorted(set(positions)):
        if last is None or p - last >= bp:
            kept.append(p)
            last = p
    return kept


@pytest.mark.parametrize(("bp", "width"), [(10, 100), (37, 40), (1, 16), (50, 1000), (100, 10)])
def test_thinning_equals_the_left_to_right_walk(spark, bp, width):
    rng = random.Random(bp * width)
    cases = {f"c{i}": [rng.randint(1, rng.choice([60, 400, 3000])) for _ in range(rng.randint(1, 150))] for i in range(30)}
    df = spark.createDataFrame([(c, p) for c, ps in cases.items() for p in ps], "chrom string, pos int")
    want = sorted((c, p) for c, ps in cases.items() for p in greedy(ps, bp))
    assert rows(A.thin_markers(df, bp, width)) == want


def test_functions_sent_to_executors_stand_alone(spark, tmp_path):
    """A driver elsewhere, whose executors cannot import the package, still runs the Python operators."""
    root = str(Path(__file__).resolve().parents[1])
    script = f"""
import sys
sys.path.insert(0, {root!r})
from varloom.session import build_session
from varloom.operators.effects import pipe_partitions
from varloom.operators.statistics import thin_markers
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
df = spark.createDataFrame([("1", 1), ("1", 2), ("1", 9)], "chrom string, pos int")
assert thin_markers(df, 5).count() == 2
assert pipe_partitions(df, "cat", df.schema).count() == 3
print("fine")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_marker_index_equals_a_global_row_number(spark):
    rng = random.Random(1)
    data = [(rng.choice(["1", "2", "X"]), rng.randint(1, 500), rng.choice("AC"), rng.choice("GT")) for _ in range(600)]
    df = spark.createDataFrame(data, "chrom string, pos int, ref string, alt string")
    want = []
    for chrom in ("1", "2", "X"):
        want += [(*v, i) for i, v in enumerate(sorted(d for d in set(data) if d[0] == chrom))]
    assert rows(A.marker_index(df, width=40)) == sorted(want)


def scan_prune(matrix, window, step, cutoff):
    """Window by window; in each, the first marker of every live pair over the cutoff is dropped."""
    n = matrix.shape[1]
    alive = np.ones(n, bool)
    r2 = np.zeros((n, n))
    for i in range(n):
        for j in range(i + 1, n):
            ok = ~np.isnan(matrix[:, i]) & ~np.isnan(matrix[:, j])
            x, y = matrix[ok, i].astype(int), matrix[ok, j].astype(int)
            # Whole numbers, so that a correlation equal to the cutoff is not taken for one over it.
            m = len(x)
            cov = int(m * (x * y).sum() - x.sum() * y.sum())
            var = int(m * (x * x).sum() - x.sum() ** 2) * int(m * (y * y).sum() - y.sum() ** 2)
            if var:
                r2[i, j] = cov * cov / var
                assert r2[i, j] == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    for start in range(0, n, step):
        for i in range(start, min(start + window, n)):
            for j in range(i + 1, min(start + window, n)):
                if r2[i, j] > cutoff:
                    alive[i] = False
    return r2, [i for i in range(n) if alive[i]]


@pytest.mark.parametrize(("window", "step", "cutoff"), [(5, 2, 0.3), (8, 3, 0.4), (50, 5, 0.52)])
def test_linkage(spark, window, step, cutoff):
    rng = np.random.default_rng(window)
    records, kept, correlation = [], set(), {}
    for case in range(6):
        n = int(rng.integers(2, 25))
        base = rng.integers(0, 3, size=(12, n)).astype(float)
        for j in range(1, n):
            if rng.random() < 0.5:
                base[:, j] = base[:, j - 1]
                base[rng.integers(0, 12), j] = rng.integers(0, 3)
        base[rng.random(base.shape) < 0.15] = np.nan
        present = [j for j in range(n) if not np.isnan(base[:, j]).all()]
        base = base[:, present]
        r2, alive = scan_prune(base, window, step, cutoff)
        kept |= {(f"c{case}", i) for i in alive}
        for i in range(len(present)):
            for j in range(i + 1, len(present)):
                correlation[(f"c{case}", i, j)] = r2[i, j]
        for s, j in zip(*np.where(~np.isnan(base))):
            records.append((int(s), f"c{case}", int(j) * 10 + 1, "A", "C", int(base[s, j])))
    kind = "subject_id int, chrom string, pos int, ref string, alt string, dosage int"
    df = spark.createDataFrame(records, kind)
    pairs = A.ld_pairs(df, window, step).collect()
    for p in pairs:
        assert p.idx_i < p.idx_j < p.idx_i // step * step + window
        assert (p.r2 or 0.0) == pytest.approx(correlation[(p.chrom, p.idx_i, p.idx_j)], abs=1e-9)
    assert {(r.chrom, r.idx) for r in A.ld_prune(df, window, step, cutoff).collect()} == kept


def test_frequencies(spark):
    calls = spark.createDataFrame(
        [("s1", "0/1"), ("s2", "1/1"), ("s3", "0/0"), ("s4", None), ("s1", "1/1")], "subject_id string, gt string"
    ).select("*", F.lit("1").alias("chrom"), F.lit(5).alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    every = A.sample_dosages(dosage(calls), missing=True)
    one = A.dosage_frequency(every, 4).collect()[0]
    assert (one.alt_alleles, one.n_samples, one.alt_freq) == (4, 3, 4 / 6)
    assert one.maf == pytest.approx(1 / 3)
    # One heterozygous and one homozygous carrier more among ten thousand: rare, and filtered out.
    rare = A.dosage_frequency(every, 10_000).collect()[0]
    assert (rare.n_samples, rare.alt_freq) == (9_999, 4 / 19_998)
    assert A.filter_maf(A.dosage_frequency(every, 10_000)).count() == 0
    samples = spark.createDataFrame([(f"s{i}",) for i in (1, 2, 3, 4, 4)], "sample string")
    assert A.dosage_frequency(every, samples).collect() == [one]
    panel = samples.distinct().select("sample", F.when(F.col("sample") < "s3", "a").otherwise("b").alias("pop"))
    by = {r["pop"]: (r.alt_alleles, r.n_samples) for r in A.population_frequency(every, panel).collect()}
    assert by == {"a": (4, 2), "b": (0, 1)}
    assert A.missing_rate(calls).collect()[0].missing_rate == pytest.approx(0.2)
    assert A.filter_missing(calls, 0.1).count() == 0 and A.filter_missing(calls, 0.2).count() == 1


def test_maf_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0.049,), (0.05,), (0.49,), (0.5,)], "maf double")
    assert rows(A.filter_maf(df)) == [(0.05,), (0.49,)]
    assert rows(A.filter_maf(df, high=0.5)) == [(0.05,), (0.49,), (0.5,)]


def test_biallelic(spark):
    df = spark.createDataFrame(
        [("1", 1, "A", "C", 1), ("1", 1, "A", "C", 1), ("1", 2, "A", "C", 1), ("1", 2, "A", "G", 1), ("1", 3, "A", "C,G", 2),
         ("1", 4, "A", "C", 1), ("1", 5, "A", "C", 2), ("1", 5, "T", "C", 2)],
        "chrom string, pos int, ref string, alt string, dosage int",
    )
    assert rows(A.biallelic_only(df), "pos") == [(1,), (1,), (4,)]
    assert rows(A.biallelic_only(df, min_alt=2), "pos") == [(1,), (1,)]
