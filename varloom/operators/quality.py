"""Checks of loaded tables. Each returns the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.aggregates import count_by, groups_above
from varloom.operators.joins import unmatched_ids

# --- row rules: a condition that marks a bad row ---------------------------------------------------------------------


def null_rule(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def prefix_rule(chrom: str = "chrom") -> Column:
    return F.lower(chrom).contains("chr")


def mt_rule(chrom: str = "chrom") -> Column:
    return F.upper(chrom) == "MT"


def alphabet_rule(allele: str = "alt") -> Column:
    return ~F.col(allele).rlike("^[ATGCN.]*$")


def bracket_rule(allele: str = "alt") -> Column:
    return (F.instr(allele, "[") != 0) | (F.instr(allele, "]") != 0)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.where(null_rule(columns))


def check_no_chr_prefix(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Rows whose chromosome still has the chr prefix."""
    return df.where(prefix_rule(chrom))


def check_mt_renamed(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Rows whose mitochondrial chromosome is still called MT."""
    return df.where(mt_rule(chrom))


def check_allele_alphabet(df: DataFrame, allele: str = "alt") -> DataFrame:
    """Rows with characters other than A, T, G, C, N and the dot."""
    return df.where(alphabet_rule(allele))


def check_no_brackets(df: DataFrame, allele: str = "alt") -> DataFrame:
    """Rows in structural (bracket) notation."""
    return df.where(bracket_rule(allele))


def check_known_position(df: DataFrame, rs_id: str, chrom: str, pos: int) -> DataFrame:
    """Rows of a well-known variant that are not at its 1-based position."""
    at = (F.col("chrom").eqNullSafe(chrom)) & (F.col("pos").eqNullSafe(pos))
    return df.where((F.col("rs_id") == rs_id) & ~at)


# --- group checks ---------------------------------------------------------------------------------------------------


def check_chrom_set(df: DataFrame, expected: Sequence[str] = S.CHROMOSOMES) -> DataFrame:
    """Chromosomes missing from the table or not expected, as (chrom, problem)."""
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in expected])).alias("expected_chrom"))
    found = df.select("chrom").distinct()
    joined = found.join(listed, F.col("chrom") == F.col("expected_chrom"), "full")
    problem = F.when(F.col("chrom").isNull() & F.col("expected_chrom").isNotNull(), "missing").when(
        F.col("expected_chrom").isNull(), "unexpected"
    )
    return joined.select(F.coalesce("chrom", "expected_chrom").alias("chrom"), problem.alias("problem")).where(
        F.col("problem").isNotNull()
    )


def check_min_rows(
    df: DataFrame, by: str = "chrom", n: int = 10_000, other: Mapping[str, int] | None = None
) -> DataFrame:
    """Groups with fewer than ``n`` rows; ``other`` sets a different minimum for some groups."""
    needed = reduce(lambda acc, kv: F.when(F.col(by) == kv[0], kv[1]).otherwise(acc), (other or {}).items(), F.lit(n))
    return count_by(df, by).where(F.col("n") < needed)


def check_max_alleles(df: DataFrame, n: int = 2) -> DataFrame:
    """Same-length variants loaded more than ``n`` times for one subject and sample."""
    rows = df.where((F.length("ref") == F.length("alt")) & (F.col("alt") != "."))
    return groups_above(rows, [*S.VARIANT_KEY, "subject_id", "sample_id"], n)


def check_subjects_loaded(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Subjects in the table without metadata, or the reverse."""
    return unmatched_ids(df, metadata, "subject_id")


def check_chroms_per_subject(df: DataFrame, n: int = len(S.CHROMOSOMES)) -> DataFrame:
    """Subjects with fewer than ``n`` different chromosomes."""
    counted = df.groupBy("subject_id").agg(F.count_distinct("chrom").alias("n_chroms"))
    return counted.where(F.col("n_chroms") < n)


def check_not_shrunk(previous: DataFrame, following: DataFrame, floor: int = 1000) -> DataFrame:
    """One row (n_previous, n_following) when a step lost rows or its input is under the floor; else none."""
    counts = previous.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        following.select(F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    totals = counts.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_previous"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_following")
    )
    return totals.where((F.col("n_following") < F.col("n_previous")) | (F.col("n_previous") < floor))


# --- many checks at once --------------------------------------------------------------------------------------------


def run_checks(
    df: DataFrame, rules: Mapping[str, Column], groups: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """(check, n_bad) for all row rules, counted in one pass over ``df``, and for the given group-check results."""
    # A global sum per rule first, so one row is unpivoted, not the table.
    sums = df.agg(*[F.coalesce(F.sum(F.coalesce(r.cast("long"), F.lit(0))), F.lit(0)).alias(n) for n, r in rules.items()])
    totals = sums.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n_bad")) for n in rules]))
    )
    for name, bad in (groups or {}).items():
        totals = totals.unionByName(bad.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(name).alias("check"), "n_bad"))
    return totals
