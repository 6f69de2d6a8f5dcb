"""Counts by batch, pruning against the sequential rule, reports planned by statistics, learning comparisons."""

from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from varloom.fixtures import load
from varloom.functions.columns import dosage
from varloom.operators import allele_counts as C
from varloom.operators import descent as D
from varloom.operators import pruning as P
from varloom.operators import statistics as A
from varloom.operators.joins import locate_genes
from varloom.plans import stored as X
from varloom.plans.trio import nbs_high_risk
from varloom.sources.writers import save_rows

# --- pruning --------------------------------------------------------------------------------------------------------


def sequential(edges, n, window, step):
    """The rule, window after window: pass after pass, marker after marker."""
    linked = {(i, j): first for i, j, first in edges}
    gone = set()
    for start in range(0, n, step):
        inside = range(start, min(start + window, n))
        changed = True
        while changed:
            changed = False
            for i in inside:
                if i in gone:
                    continue
                for j in inside:
                    if j > i and j not in gone and (i, j) in linked:
                        gone.add(i if linked[i, j] else j)
                        changed = True
                        break
    return sorted(gone)


@pytest.mark.parametrize("window, step, block_windows, share", [(10, 3, 4, 0.3), (10, 5, 2, 0.7), (7, 7, 1, 0.5), (12, 1, 12, 0.2)])
def test_pruning_is_the_sequential_rule(spark, window, step, block_windows, share):
    """Blocks of a few windows, so what blocks pass on decides most markers."""
    rng = random.Random(window * step)
    n = 160
    made = {"1": [], "2": []}
    for chrom, listed in made.items():
        for i in range(n):
            for j in range(i + 1, min(n, i // step * step + window)):
                if rng.random() < share:
                    listed.append((i, j, rng.random() < 0.4))
    edges = spark.createDataFrame([(c, *e) for c, listed in made.items() for e in listed], "chrom string, i long, j long, first_goes boolean")
    got = P.pruned_markers(edges, window, step, block_windows)
    want = [(c, i) for c, listed in made.items() for i in sequential(listed, n, window, step)]
    assert rows(got, "chrom", "idx") == sorted(want) and len(want) > 100


def test_pruning_carries_far(spark):
    """A chain in which every decision hangs on the one before it, over many blocks."""
    n, window, step = 120, 6, 2
    made = [("1", i, i + 1, False) for i in range(n - 1)]
    edges = spark.createDataFrame(made, "chrom string, i long, j long, first_goes boolean")
    got = P.pruned_markers(edges, window, step, 3)
    assert rows(got) == [("1", i) for i in sequential([e[1:] for e in made], n, window, step)]
    assert P.pruned_markers(edges.limit(0), window, step).count() == 0


def test_the_rarer_marker_goes(spark):
    """Two markers with the same carriers but for one sample; a third, unlinked one stays."""
    kind = "subject_id long, chrom string, pos int, ref string, alt string, dosage int"
    made = [(s, "1", 100, "A", "C", int(s < 6)) for s in range(20)] + [(s, "1", 200, "A", "C", int(s < 7)) for s in range(20)]
    made += [(s, "1", 300, "A", "C", s % 2) for s in range(20)]
    dosages = spark.createDataFrame(made, kind)
    kept = P.prune_by_frequency(dosages, A.dosage_frequency(dosages, 20))
    assert rows(kept, "pos", "idx") == [(200, 1), (300, 2)]
    swapped = dosages.withColumn("pos", 500 - F.col("pos"))
    assert rows(P.prune_by_frequency(swapped, A.dosage_frequency(swapped, 20)), "pos") == [(200,), (300,)]
    equal = dosages.where("pos <> 200").unionByName(dosages.where("pos = 100").withColumn("pos", F.lit(200)))
    assert rows(P.prune_by_frequency(equal, A.dosage_frequency(equal, 20)), "pos") == [(100,), (300,)]


def test_pruned_calls_leave_no_linked_pair(spark, sf_dir):
    dosages = A.sample_dosages(dosage(load(spark, sf_dir, "calls")))
    frequencies = A.dosage_frequency(dosages, 1000)
    kept = P.prune_by_frequency(dosages, frequencies, block_windows=10)
    pairs = A.ld_pairs(dosages).where("r2 > 0.5").select("chrom", "idx_i", "idx_j")
    left = kept.select("chrom", F.col("idx").alias("idx_i"))
    both = pairs.join(left, ["chrom", "idx_i"]).join(left.withColumnRenamed("idx_i", "idx_j"), ["chrom", "idx_j"])
    assert pairs.count() > 0 and both.count() == 0


# --- counts by batch ------------------------------------------------------------------------------------------------

DOSES = "subject_id long, chrom string, pos int, ref string, alt string, dosage int"


def test_batches_add_up_and_can_be_stored_again(spark, tmp_path):
    rng = random.Random(6)
    made = [(s, "1", p, "A", "C", rng.choice([0, 1, 2, None])) for s in range(40) for p in range(5) if rng.random() < 0.7]
    doses = spark.createDataFrame(made, DOSES)
    people = spark.range(50).withColumnRenamed("id", "subject_id").withColumn("pop", F.when(F.col("subject_id") % 3 == 0, "x").otherwise("y"))
    path = str(tmp_path / "counts")
    for batch, where in (("a", "subject_id < 17"), ("b", "subject_id >= 17 and subject_id < 45"), ("c", "subject_id >= 45")):
        C.add_batch(doses.where(where), people.where(where), path, batch)
    C.add_batch(doses.where("subject_id < 17"), people.where("subject_id < 17").unionByName(people.where("subject_id < 17")), path, "a")
    assert rows(C.stored_frequency(spark, path)) == rows(A.dosage_frequency(doses, 50))
    grouped = str(tmp_path / "grouped")
    for batch, where in (("a", "subject_id < 17"), ("b", "subject_id >= 17")):
        C.add_batch(doses.where(where), people.where(where), grouped, batch, by=["pop"])
    panel = people.withColumnRenamed("subject_id", "sample")
    want = A.population_frequency(doses, panel)
    assert rows(C.stored_frequency(spark, grouped, by=["pop"]), *want.columns) == rows(want)


def test_a_batch_without_calls_widens_the_cohort(spark, tmp_path):
    doses = spark.createDataFrame([(1, "1", 5, "A", "C", 2), (2, "1", 5, "A", "C", None)], DOSES)
    path = str(tmp_path / "counts")
    C.add_batch(doses, spark.createDataFrame([(1,), (2,), (None,)], "s long"), path, "a")
    C.add_batch(doses.limit(0), spark.range(10, 12), path, "b")
    assert rows(C.stored_frequency(spark, path), "alt_alleles", "n_samples") == [(2, 3)]


# --- plans by statistics --------------------------------------------------------------------------------------------


def test_statistics_change_the_join_order_and_not_the_rows(spark, sf_dir):
    key = ["chrom", "pos", "ref", "alt"]
    known = load(spark, sf_dir, "sites").select(*key)
    for table, column in {"kaviar": "kav_freq", "clinvar": "clin_sig", "dbnsfp": "dann_score"}.items():
        known = known.join(load(spark, sf_dir, table).select(*key, column), key, "left")
    regions = locate_genes(load(spark, sf_dir, "gene_list"), load(spark, sf_dir, "genes")).drop("strand", "phenotype")
    calls = load(spark, sf_dir, "calls").select("sample_id", *key, "qual", "dp", "gt")
    coding = load(spark, sf_dir, "coding").select(*key, "effect", "impact")
    tables = {"calls": calls, "located": X.locate_variants(known, regions, shift=1000), "variants": known, "coding": coding}
    names = {n: f"st{uuid.uuid4().hex}_{n}" for n in tables}
    for n, made in tables.items():
        save_rows(made, names[n])

    def report():
        return X.high_risk_stored(spark, *names.values())

    def order(df):
        return re.findall(r"st[0-9a-f]{32}_(\w+)\[", df._jdf.queryExecution().optimizedPlan().toString())

    try:
        plain = report()
        assert order(plain) == ["calls", "located", "variants", "coding"]
        X.analyze(spark, *names.values())
        with X.session_settings(spark, X.COST_BASED):
            planned = report()
            assert sorted(order(planned)) == sorted(order(plain)) and order(planned) != order(plain)
            found = rows(planned)
        assert spark.conf.get("spark.sql.cbo.enabled") == "false"
        columns = planned.columns
        whole = nbs_high_risk(load(spark, sf_dir, "calls").select("sample_id", *key, "qual", "dp", "gt"), regions, known, coding)
        assert found == rows(plain, *columns) == rows(whole, *columns) and found
        extended = spark.sql(f"DESCRIBE EXTENDED {names['calls']} qual").where("info_name = 'histogram'").first()
        assert extended is not None and "num_of_bins" in extended["info_value"]
    finally:
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")


# --- learning -------------------------------------------------------------------------------------------------------


def test_descents_find_a_line_and_are_compared(spark):
    rng = random.Random(2)
    made = [(float(a + b > 1), a, b) for a, b in ((rng.random() * 2 - 0.5, rng.random() * 2 - 0.5) for _ in range(300))]
    df = spark.createDataFrame([(y, a, b, 1.0) for y, a, b in made], "label double, a double, b double, one double")
    found = {r.model: r.value for r in D.compare_descents(df, df, ["a", "b", "one"], iterations=60).collect()}
    assert set(found) == set(D.DESCENTS) and found["svm"] < 0.15 and found["logistic"] < 0.15 and found["linear"] < 0.25
