"""Findings in family trios: annotation of calls in gene regions, inheritance classes, reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import (
    normalize_gt, with_blk_pos, with_clin_patho, with_family_id, with_kaviar_rare, with_member, with_member_lookup,
    with_predicted_damaging, with_var_id,
)
from varloom.functions.predicates import filter_autosomes, filter_high_risk, filter_quality, filter_trio, label_predictive
from varloom.operators import trio as R
from varloom.operators.aggregates import concat_findings
from varloom.operators.joins import join_locus_alt, join_on_variant, left_join_variant
from varloom.operators.ranges import range_join, range_join_inner, range_strategy
from varloom.session import stage

CALL_COLUMNS = ["sample_id", "chrom", "pos", "ref", "alt", "qual", "filter", "gt"]
EFFECT_COLUMNS = ["effect", "impact", "feature_id", "biotype", "hgvs_c", "hgvs_p"]


def _blocks(points: DataFrame) -> dict:
    """Range-join options for a table that carries its position block."""
    return {"block": "blk_pos", "width": S.BLOCK_WIDTH} if "blk_pos" in points.columns else {}


def region_variants(
    regions: DataFrame,
    *,
    kaviar: DataFrame,
    clinvar: DataFrame,
    dbnsfp: DataFrame,
    effects: DataFrame,
    kav_freq: float = 0.03,
    dann: float = 0.96,
    dann_in_prediction: bool = False,
    start: str = "txstart",
    stop: str = "txstop",
    strategy: str | None = None,
) -> DataFrame:
    """Autosomal variants in gene regions with effect, rarity, significance, predictions and the predictive label.

    Everything here depends on the variant alone, so its size follows the genome regions and not the cohort.
    Variants without a functional prediction or without an effect are not reported.
    """
    blocks = _blocks(effects)
    listed = filter_autosomes(effects).select(*S.VARIANT_KEY, *EFFECT_COLUMNS, *(["blk_pos"] if blocks else []))
    located = range_join_inner(listed, regions, start=start, stop=stop, strategy=strategy, **blocks).drop(start, stop, "blk_pos")
    scored_by = dbnsfp.columns
    predictions = [c for c in S.DAMAGING_CALLS if c in scored_by]
    scores = dbnsfp.select(*S.LOCUS_ALT_KEY, *predictions, "cadd_raw", "dann_score", "interpro_domain")
    known = clinvar.select(*S.LOCUS_ALT_KEY, "clin_sig", "clin_dbn")
    scored = join_locus_alt(join_locus_alt(located, scores, "inner"), known, "left")
    merged = left_join_variant(scored, kaviar.select(*S.VARIANT_KEY, "kav_freq")).distinct()
    labelled = with_clin_patho(with_kaviar_rare(merged, kav_freq))
    labelled = with_predicted_damaging(labelled, dann if dann_in_prediction else None)
    return with_var_id(label_predictive(labelled, dann))


def annotate_trios(
    calls: DataFrame,
    regions: DataFrame,
    *,
    members: Iterable[str] | str = "all",
    samples: Iterable[str] | str = "all",
    start: str = "txstart",
    stop: str = "txstop",
    keep: Iterable[str] = (),
    **tables,
) -> DataFrame:
    """Calls of the annotated variants in gene regions, without repeated rows.

    The variants are annotated once each; the calls only take part in a semi join with the small region list, one
    deduplication and one join on the variant key. Both inputs of that join are free of copies, so its result is too.
    Calls stored by (chrom, blk_pos) are read only in the blocks of the regions. The regions are measured once for both
    interval joins.
    """
    strategy = range_strategy(regions, start=start, stop=stop)
    variants = region_variants(regions, start=start, stop=stop, strategy=strategy, **tables)
    picked = filter_trio(filter_autosomes(calls), members, samples)
    located = range_join(picked, regions, "left_semi", start=start, stop=stop, strategy=strategy, **_blocks(calls))
    return join_on_variant(normalize_gt(located.select(*CALL_COLUMNS, *keep)).distinct(), variants)


def classify(annotated: DataFrame, same_family: bool = True) -> DataFrame:
    """Dominant, homozygous recessive and compound heterozygous findings of annotated trios, in one table.

    The annotated rows are staged once, because the three classes and both parents are cut from them.
    """
    rows = stage(annotated, "trios")
    candidates = R.parent_match(R.het_recessive(rows), R.het_parents(rows), same_family)
    return concat_findings(
        dominant=R.dominant(rows), hom_recessive=R.hom_recessive(rows), comp_het=R.compound_hets(candidates)
    )


def acmg_report(calls: DataFrame, regions: DataFrame, members: DataFrame | None = None, **tables) -> DataFrame:
    """Reportable-gene findings. Members come from a lookup table, or from the calls when they have the column."""
    same_family = tables.pop("same_family", True)
    if members is None:
        return classify(annotate_trios(calls, regions, keep=["member", "family_id"], **tables), same_family)
    annotated = annotate_trios(calls, regions, keep=["family_id"], **tables)
    return classify(with_member_lookup(annotated, members), same_family)


def nbs_annotated(calls: DataFrame, regions: DataFrame, **tables) -> DataFrame:
    """Newborn-screening calls, with member and family read from the sample id."""
    annotated = annotate_trios(calls, regions, dann_in_prediction=True, **tables)
    return with_family_id(with_member(annotated))


def nbs_report(calls: DataFrame, regions: DataFrame, **tables) -> DataFrame:
    """Newborn-screening findings."""
    same_family = tables.pop("same_family", True)
    return classify(nbs_annotated(calls, regions, **tables), same_family)


def nbs_high_risk(
    calls: DataFrame,
    regions: DataFrame,
    variants: DataFrame,
    coding: DataFrame,
    *,
    qual: float = 30,
    dp: float = 10,
    kav_freq: float = 0.01,
    shift: int = 1000,
    pad: int = 0,
    start: str = "txstart",
    stop: str = "txstop",
) -> DataFrame:
    """Well-called variants in gene regions that are rare with high impact, or pathogenic.

    ``shift`` moves both region bounds; ``pad`` widens the region on both sides instead. Risk and region are properties of
    the variant, so the variants are reduced first and the calls join only that small remainder.
    """
    harmful = filter_high_risk(join_on_variant(variants, coding), threshold=kav_freq)
    located = range_join_inner(harmful, regions, start=start, stop=stop, shift=shift, pad=pad)
    located = located.withColumns(
        {"region_start": F.col(start) + (shift - pad), "region_stop": F.col(stop) + (shift + pad)}
    ).drop(start, stop)
    called = normalize_gt(filter_quality(calls, qual, dp))
    if "blk_pos" not in calls.columns:
        return join_on_variant(called, located)
    return join_on_variant(called, with_blk_pos(located), key=S.BLOCK_KEY)
