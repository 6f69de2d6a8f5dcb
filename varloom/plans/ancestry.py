"""Inputs and results of supervised ancestry runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import dosage, missing_ids
from varloom.operators import statistics as A
from varloom.operators.aggregates import merge_genotypes
from varloom.operators.joins import map_population, members_in, zip_columns
from varloom.session import stage


def reference_markers(
    dosages: DataFrame, cohort: DataFrame | int, low: float = 0.05, high: float = 0.49, window: int = 50, step: int = 5, cutoff: float = 0.5
) -> DataFrame:
    """Reference markers by minor-allele frequency over the cohort, then pruned for linkage among called dosages.

    The common markers are staged: their size is then known, so that few of them meet the dosages without a shuffle.
    """
    common = stage(A.filter_maf(A.dosage_frequency(dosages, cohort), low, high).select(*S.VARIANT_KEY), "common")
    called = dosages.where(F.col("dosage").isNotNull())
    return A.ld_prune(members_in(called, common, S.VARIANT_KEY), window, step, cutoff)


def subject_genotypes(calls: DataFrame, markers: DataFrame, max_missing: float = 0.999) -> DataFrame:
    """Subject calls at marker positions: biallelic sites with few missing calls, every variant with an id.

    The calls at the markers are read twice, for the sites and for the rows, so they are staged.
    """
    at_markers = stage(dosage(members_in(calls, markers, ["chrom", "pos"])), "at-markers")
    return missing_ids(A.biallelic_only(at_markers, max_missing=max_missing))


def ancestry_inputs(
    reference_calls: DataFrame,
    subject_calls: DataFrame,
    panel: DataFrame,
    level: str = "super",
    **marker_options,
) -> DataFrame:
    """Merged genotypes on shared markers, in panel order, with the known population or ``-`` for each sample.

    Panel order is super population, population, sample, with samples outside the panel last; ties are broken by
    position, so that the range sort can split a sample with very many rows.
    """
    dosages = stage(A.sample_dosages(dosage(reference_calls), missing=True), "reference")
    markers = stage(reference_markers(dosages, panel.select("sample"), **marker_options), "markers")
    reference = members_in(dosages.where(F.col("dosage").isNotNull()), markers, S.VARIANT_KEY)
    needed = subject_calls.select("subject_id", *S.VARIANT_KEY, "gt", "rs_id")
    subjects = A.sample_dosages(subject_genotypes(needed, markers))
    merged = merge_genotypes(reference, subjects).withColumnRenamed("subject_id", "sample")
    known = map_population(merged, panel, level)
    ordered = known.join(panel.select("sample", "super_pop", "pop"), "sample", "left")
    return ordered.orderBy(F.asc_nulls_last("super_pop"), "pop", "sample", "chrom", "pos", "alt").select(*known.columns)


def ancestry_results(
    fractions: DataFrame,
    samples: DataFrame,
    panel: DataFrame,
    populations: Mapping[str, str],
    level: str = "super",
    keys: Sequence[str] = ("sample",),
) -> DataFrame:
    """Population fractions of the samples whose population is not known, columns named by population."""
    labelled = map_population(zip_columns(samples, fractions, keys[0]), panel, level)
    unknown = labelled.where(F.col("known_pop") == "-").drop("known_pop")
    return unknown.withColumnsRenamed(dict(populations))
