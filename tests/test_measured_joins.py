"""Interval calls and known variants: the join goes by the measured size, not by Spark's estimate of the files."""

from tests.conftest import rows
from varloom.operators import hints
from varloom.operators import ranges as R


def _tables(spark):
    calls = spark.createDataFrame(
        [(1, "1", 10, 12, "A", "A", "C"), (2, "1", 990, 1005, "G", "T", "T"), (3, "2", 5, 4_000_000, "A", "C", "G")],
        "c int, chr string, start int, stop int, ref string, allele1seq string, allele2seq string",
    )
    known = spark.createDataFrame(
        [(1, "1", 11, "A", "C"), (2, "1", 1001, "G", "T"), (3, "2", 3_000_000, "A", "G"), (4, "2", 9, "A", "T"), (5, None, 11, "A", "C")],
        "k int, chrom string, pos int, ref string, alt string",
    )
    return calls, known


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_known_side_is_shuffled(spark, monkeypatch):
    calls, known = _tables(spark)
    small = R.interval_allele_join(calls, known)
    assert "BroadcastHashJoin" in _plan(small)
    monkeypatch.setattr(R, "MAX_BROADCAST_BYTES", hints.table_bytes(known) * len(R.ALLELE_BINS) - 1)
    large = R.interval_allele_join(calls, known)
    assert "SortMergeJoin" in _plan(large) and "BroadcastHashJoin" not in _plan(large)
    assert rows(small, "c", "k") == rows(large, "c", "k") == [(1, 1), (2, 2), (3, 3)]
