"""Inheritance classes of newborn findings.

Inputs are annotated calls with ``member``, ``family_id``, ``inheritance``, ``gt``, ``gene`` and ``predictive``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S

HET, HOM = "0/1", "1/1"


def _newborn(df: DataFrame, rule: Column) -> DataFrame:
    return df.where((F.col("member") == "NB") & F.col("predictive") & rule)


def dominant(df: DataFrame) -> DataFrame:
    """Predictive newborn variants in dominant genes."""
    return _newborn(df, F.col("inheritance") == "AD")


def hom_recessive(df: DataFrame) -> DataFrame:
    """Predictive homozygous newborn variants in recessive genes."""
    return _newborn(df, (F.col("inheritance") == "AR") & (F.col("gt") == HOM))


def het_recessive(df: DataFrame) -> DataFrame:
    """Predictive heterozygous newborn variants in recessive genes: compound-het candidates."""
    return _newborn(df, (F.col("inheritance") == "AR") & (F.col("gt") == HET))


def het_parents(df: DataFrame) -> DataFrame:
    """Heterozygous variants of mothers and fathers."""
    return df.where(F.col("member").isin("M", "F") & (F.col("gt") == HET))


def parent_match(
    newborn: DataFrame, parents: DataFrame, same_family: bool = True, key: Sequence[str] = S.VARIANT_KEY
) -> DataFrame:
    """Newborn variants that a parent also carries, labelled ``from_parent``.

    The parents are first reduced to distinct (variant, family, parent) rows, so a common variant cannot multiply:
    each newborn row matches at most one mother row and one father row. ``same_family=False`` matches any family.
    """
    on = [*key, "family_id"] if same_family else list(key)
    carriers = parents.select(*on, F.col("member").alias("from_parent")).distinct()
    return newborn.join(carriers, on).select(*newborn.columns, "from_parent").distinct()


def compound_het_groups(candidates: DataFrame, group: Sequence[str] = ("gene", "family_id")) -> DataFrame:
    """Groups with variants at more than one position and at least one from each parent.

    More than one position is a minimum unlike the maximum, so one partial aggregate decides, without a distinct count.
    """
    stats = candidates.groupBy(*group).agg(
        F.min("pos").alias("__first"),
        F.max("pos").alias("__last"),
        F.max(F.col("from_parent") == "M").alias("__mother"),
        F.max(F.col("from_parent") == "F").alias("__father"),
    )
    held = (F.col("__first") < F.col("__last")) & F.col("__mother") & F.col("__father")
    return stats.where(held).select(*group)


def compound_hets(candidates: DataFrame, group: Sequence[str] = ("gene", "family_id")) -> DataFrame:
    """All rows of the compound-heterozygous groups."""
    return candidates.join(compound_het_groups(candidates, group), list(group), "left_semi").select(*candidates.columns)


def review_findings(findings: DataFrame, group: Sequence[str] = ("gene", "family_id")) -> DataFrame:
    """Findings that break the rule of their class, one row per broken rule with its ``reason``.

    ``findings`` carries ``var_class`` (dominant, hom_recessive, comp_het) and ``from_parent``.
    """
    stats = (
        findings.where(F.col("var_class") == "comp_het")
        .groupBy(*group)
        .agg(
            (F.min("pos") == F.max("pos")).alias("__one_position"),
            (~F.max(F.col("from_parent") == "M")).alias("__no_mother"),
            (~F.max(F.col("from_parent") == "F")).alias("__no_father"),
        )
        .withColumn("var_class", F.lit("comp_het"))
    )
    broken = {
        "not_dominant": (F.col("var_class") == "dominant") & ~F.col("inheritance").eqNullSafe("AD"),
        "not_homozygous_recessive": (F.col("var_class") == "hom_recessive")
        & ~(F.col("inheritance").eqNullSafe("AR") & F.col("gt").eqNullSafe(HOM)),
        "not_heterozygous_recessive": (F.col("var_class") == "comp_het")
        & ~(F.col("inheritance").eqNullSafe("AR") & F.col("gt").eqNullSafe(HET)),
        "one_position": F.col("__one_position"),
        "no_mother_variant": F.col("__no_mother"),
        "no_father_variant": F.col("__no_father"),
    }
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in broken.items()]))
    joined = findings.join(stats, [*group, "var_class"], "left")
    return joined.select(*findings.columns, F.explode(reasons).alias("reason"))
