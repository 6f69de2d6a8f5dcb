"""Inheritance classes on hand-written families and against brute force."""

import random
from itertools import product

from pyspark.sql import functions as F

from tests.conftest import rows
from varloom.operators import trio as R
from varloom.operators.aggregates import concat_findings, summarize_findings
from varloom.plans.trio import classify

KIND = (
    "member string, family_id string, gene string, chrom string, pos int, ref string, alt string, gt string, "
    "inheritance string, predictive boolean, phenotype string"
)


def call(member, family, gene, pos, gt="0/1", inheritance="AR", predictive=True):
    return (member, family, gene, "1", pos, "A", "C", gt, inheritance, predictive, f"{gene} disease")


def test_classes(spark):
    data = [
        call("NB", "f1", "D", 1, "0/1", "AD"), call("M", "f1", "D", 1, "0/1", "AD"), call("NB", "f1", "D", 2, "0/1", "AD", False),
        call("NB", "f1", "R", 3, "1/1"), call("NB", "f1", "R", 4, "0/1"),
        call("NB", "f1", "C", 5), call("M", "f1", "C", 5), call("NB", "f1", "C", 6), call("F", "f1", "C", 6),
    ]
    out = rows(classify(spark.createDataFrame(data, KIND)), "var_class", "pos", "from_parent")
    assert out == [("comp_het", 5, "M"), ("comp_het", 6, "F"), ("dominant", 1, "NA"), ("hom_recessive", 3, "NA")]


def test_parent_of_another_family_needs_the_old_form(spark):
    newborn = spark.createDataFrame([call("NB", "f1", "C", 5)], KIND)
    parents = spark.createDataFrame([call("M", "f2", "C", 5)] * 3, KIND)
    assert R.parent_match(newborn, parents).count() == 0
    assert rows(R.parent_match(newborn, parents, same_family=False), "pos", "from_parent") == [(5, "M")]


def test_compound_hets_equal_brute_force(spark):
    rng = random.Random(8)
    data = set()
    for gene, family in product([f"g{i}" for i in range(12)], [f"f{i}" for i in range(12)]):
        for _ in range(rng.randint(0, 5)):
            data.add((gene, family, rng.randint(1, 3), rng.choice(["M", "F"])))
    want = set()
    for gene, family in {(d[0], d[1]) for d in data}:
        group = [d for d in data if d[:2] == (gene, family)]
        mother, father = [{d[2] for d in group if d[3] == p} for p in "MF"]
        if any(m != f for m in mother for f in father):
            want |= set(group)
    df = spark.createDataFrame(sorted(data), "gene string, family_id string, pos int, from_parent string")
    assert rows(R.compound_hets(df)) == sorted(want)


def test_compound_hets_without_family_are_left_out(spark):
    df = spark.createDataFrame(
        [("g", None, 1, "M"), ("g", None, 2, "F")], "gene string, family_id string, pos int, from_parent string"
    )
    assert R.compound_hets(df).count() == 0


def test_review_flags_each_broken_rule(spark):
    def found(var_class, parent, *args, **options):
        return (*call("NB", *args, **options), var_class, parent)

    data = [
        found("dominant", "NA", "f1", "A", 1, inheritance="AD"), found("dominant", "NA", "f1", "A", 2, inheritance="AR"),
        found("hom_recessive", "NA", "f1", "B", 3, gt="1/1"), found("hom_recessive", "NA", "f1", "B", 4, gt="0/1"),
        found("comp_het", "M", "f1", "C", 5), found("comp_het", "F", "f1", "C", 6),
        found("comp_het", "M", "f1", "D", 7), found("comp_het", "M", "f1", "D", 8, gt="1/1"),
        found("comp_het", "F", "f1", "E", 9),
    ]
    out = R.review_findings(spark.createDataFrame(data, KIND + ", var_class string, from_parent string"))
    assert rows(out, "pos", "reason") == [
        (2, "not_dominant"), (4, "not_homozygous_recessive"), (7, "no_father_variant"), (8, "no_father_variant"),
        (8, "not_heterozygous_recessive"), (9, "no_mother_variant"), (9, "one_position"),
    ]


def test_summary_counts(spark):
    data = [call("NB", "f1", "A", 1, inheritance="AD"), call("NB", "f2", "A", 1, inheritance="AD"), call("NB", "f1", "B", 2, "1/1")]
    df = spark.createDataFrame(data, KIND)
    findings = concat_findings(dominant=R.dominant(df), hom_recessive=R.hom_recessive(df))
    assert set(rows(findings.select("from_parent"))) == {("NA",)}
    assert rows(summarize_findings(findings).where(F.col("var_class") == "dominant")) == [
        ("dominant", "gene", "A", 2), ("dominant", "phenotype", "A disease", 2), ("dominant", "total", "all", 2)
    ]
