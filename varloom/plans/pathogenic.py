"""ClinVar-pathogenic variants by user filters, and the comparison of two analyses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import pathogenic, report_key, with_alt_call
from varloom.functions.predicates import build_predicate, filter_find_in_set
from varloom.operators.joins import join_gene_list, join_on_variant, members_in, members_not_in
from varloom.operators.ranges import interval_allele_join


def clinvar_pathogenic(
    calls: DataFrame,
    clinvar: DataFrame,
    filters: Mapping[str, str] | None = None,
    platform: str = "illumina",
    sep: str = "|",
    strict: bool = True,
) -> DataFrame:
    """Calls of pathogenic variants: position calls joined on the variant key, interval calls by overlap and allele."""
    known = filter_find_in_set(clinvar, sep=sep, strict=strict)
    chosen = calls.where(build_predicate(filters or {}))
    join = {"illumina": join_on_variant, "cgi": interval_allele_join}[platform]
    return join(chosen, known)


def clinvar_with_gene_list(
    clinvar: DataFrame, gene_list: DataFrame, patterns: Mapping[str, str] = S.PATHOGENIC_LOOSE
) -> DataFrame:
    """Pathogenic variants with their gene-list columns where the gene is listed."""
    return join_gene_list(clinvar.where(pathogenic(F.col("clin_sig"), patterns)), gene_list)


def cohort_findings(
    calls: DataFrame, clinvar: DataFrame, gene_list: DataFrame, samples: DataFrame | None = None
) -> DataFrame:
    """Homozygous interval calls of parents that carry a pathogenic variant, with the call label and a report key.

    ``samples`` (sample_id) restricts the cohort.
    """
    parents = calls.where(
        (F.col("sample_id").endswith("F") | F.col("sample_id").endswith("M")) & (F.col("zygosity") == "hom")
    )
    if samples is not None:
        parents = members_in(parents, samples, ["sample_id"])
    found = with_alt_call(interval_allele_join(parents, clinvar_with_gene_list(clinvar, gene_list)))
    return found.withColumn("report_id", report_key("gene", "chr", "ref", "allele1seq", "sample_id"))


def compare_cohorts(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Findings, genes and samples on one side only or shared: (side, n_findings, n_genes, n_samples).

    Both sides are stacked and grouped by finding, so one shuffle with map-side reduction answers the membership
    question in both directions; a finding reported many times counts once.
    """
    key = ["report_id", "gene", "sample_id"]
    flagged = [
        df.select(*key, F.lit(side == 0).alias("in_ours"), F.lit(side == 1).alias("in_theirs"))
        for side, df in enumerate((ours, theirs))
    ]
    findings = (
        flagged[0].unionByName(flagged[1]).groupBy(*key).agg(F.max("in_ours").alias("o"), F.max("in_theirs").alias("t"))
    )
    side = F.when(F.col("o") & F.col("t"), "shared").when(F.col("o"), "only_ours").otherwise("only_theirs")
    return (
        findings.withColumn("side", side)
        .groupBy("side")
        .agg(
            F.count(F.lit(1)).alias("n_findings"),
            F.count_distinct("gene").alias("n_genes"),
            F.count_distinct("sample_id").alias("n_samples"),
        )
    )


def only_in(findings: DataFrame, other: DataFrame, key: tuple[str, ...] = ("report_id",)) -> DataFrame:
    """Findings whose key the other side does not have, with all their columns."""
    return members_not_in(findings, other, list(key))
