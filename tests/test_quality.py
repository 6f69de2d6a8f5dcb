"""Each check on one clean and one dirty table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from varloom import schema as S
from varloom.operators import quality as Q

KIND = "chrom string, pos int, ref string, alt string, subject_id int, sample_id string, rs_id string"


def table(spark, *changes):
    base = [(c, 10, "A", "C", 1, "s1", "rs1" if c == "7" else None) for c in S.CHROMOSOMES]
    return spark.createDataFrame(base + list(changes), KIND)


CHECKS = {
    "not_null": (lambda d: Q.check_not_null(d, ["chrom", "ref"]), (None, 1, "A", "C", 1, "s1", None)),
    "chrom_set": (Q.check_chrom_set, ("MT", 1, "A", "C", 1, "s1", None)),
    "no_chr_prefix": (Q.check_no_chr_prefix, ("chr1", 1, "A", "C", 1, "s1", None)),
    "mt_renamed": (Q.check_mt_renamed, ("mt", 1, "A", "C", 1, "s1", None)),
    "alphabet": (Q.check_allele_alphabet, ("1", 1, "A", "C*", 1, "s1", None)),
    "brackets": (Q.check_no_brackets, ("1", 1, "A", "]2:5]C", 1, "s1", None)),
    "known_position": (lambda d: Q.check_known_position(d, "rs1", "7", 10), ("7", 9, "A", "C", 1, "s1", "rs1")),
    "chroms_per_subject": (Q.check_chroms_per_subject, ("1", 1, "A", "C", 2, "s2", None)),
}


@pytest.mark.parametrize("name", CHECKS)
def test_clean_passes_and_dirty_fails(spark, name):
    check, dirt = CHECKS[name]
    assert check(table(spark)).count() == 0
    assert check(table(spark, dirt)).count() == 1


def test_max_alleles(spark):
    copy = ("1", 10, "A", "C", 1, "s1", None)
    assert Q.check_max_alleles(table(spark, copy)).count() == 0
    assert rows(Q.check_max_alleles(table(spark, copy, copy)), "n") == [(3,)]
    indel = ("1", 11, "A", "CC", 1, "s1", None)
    assert Q.check_max_alleles(table(spark, indel, indel, indel)).count() == 0


def test_missing_chromosome_is_reported(spark):
    assert rows(Q.check_chrom_set(table(spark).where("chrom <> 'M'"))) == [("M", "missing")]
    assert Q.check_chrom_set(table(spark).where("chrom <> 'M'"), S.CHROMOSOMES[:-1]).count() == 0


def test_min_rows(spark):
    df = table(spark, ("1", 2, "A", "C", 1, "s1", None))
    assert Q.check_min_rows(df, n=1).count() == 0
    assert Q.check_min_rows(df, n=2).count() == 24
    assert Q.check_min_rows(df, n=1, other={"1": 3}).collect()[0].chrom == "1"


def test_subjects_loaded(spark):
    files = spark.createDataFrame([(1,)], "subject_id int")
    assert Q.check_subjects_loaded(table(spark), files).count() == 0
    more = files.union(spark.createDataFrame([(5,)], "subject_id int"))
    assert rows(Q.check_subjects_loaded(table(spark), more)) == [(None, 5)]


def test_not_shrunk(spark):
    big, small = spark.range(1200), spark.range(1100)
    assert Q.check_not_shrunk(small, big).count() == 0
    assert rows(Q.check_not_shrunk(big, small)) == [(1200, 1100)]
    assert rows(Q.check_not_shrunk(spark.range(10), big)) == [(10, 1200)]


def test_run_checks_counts_row_rules_in_one_pass(spark):
    df = table(spark, (None, 1, "A", "C", 1, "s1", None), ("chr1", 1, "A", "[", 1, "s1", None))
    rules = {"null": Q.null_rule(["chrom"]), "prefix": Q.prefix_rule(), "alphabet": Q.alphabet_rule()}
    out = Q.run_checks(df, rules, {"set": Q.check_chrom_set(df)})
    assert rows(out) == [("alphabet", 1), ("null", 1), ("prefix", 1), ("set", 2)]
    one = Q.run_checks(df, rules)
    assert one._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert rows(Q.run_checks(df.where(F.lit(False)), rules)) == [("alphabet", 0), ("null", 0), ("prefix", 0)]
