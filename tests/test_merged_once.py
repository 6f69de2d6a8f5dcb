"""Merged genotype sets are computed once."""

from pyspark.sql import functions as F

from tests.conftest import rows
from varloom.operators import aggregates as A


def test_sets_are_stored_before_they_meet(spark):
    kind = "chrom string, pos int, ref string, alt string"
    known = spark.createDataFrame([("1", 1, "A", "C"), ("1", 1, "A", "C"), ("1", 2, "A", "C"), (None, 3, "A", "C")], kind)
    others = spark.createDataFrame([("1", 1, "A", "C"), ("2", 2, "A", "C"), (None, 3, "A", "C")], kind)
    label = lambda df, n: df.withColumn("s", F.md5(F.concat(F.lit(n), "ref")))
    both = A.merge_genotypes(label(known, "k"), label(others, "o"))
    assert both.columns == ["chrom", "pos", "ref", "alt", "s"]
    assert [r[:2] for r in rows(both)] == [("1", 1)] * 3
    assert "md5" not in both._jdf.queryExecution().executedPlan().toString()
