"""Joins on variant keys.

Equality joins are left to Spark's planner: a side is broadcast only when its measured size is under the session
threshold, otherwise both sides are shuffled on the full key and skewed partitions are split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.hints import with_strategy

KeyList = Sequence[str]


def keyed_join(
    left: DataFrame, right: DataFrame, on: KeyList, how: str = "inner", strategy: str | None = None
) -> DataFrame:
    """Equality join that keeps the left columns in order and appends the columns only the right side has."""
    kept = left.columns
    extra = [c for c in right.columns if c not in on and c not in kept]
    joined = left.join(with_strategy(right.select(*on, *extra), strategy), list(on), how)
    return joined.select(*kept, *extra)


def join_on_variant(
    left: DataFrame, right: DataFrame, strategy: str | None = None, key: KeyList = S.VARIANT_KEY
) -> DataFrame:
    """Inner join on (chrom, pos, ref, alt).

    With ``key=BLOCK_KEY`` the position block joins too, so a table stored by block is read only where the other side
    has variants.
    """
    return keyed_join(left, right, key, "inner", strategy)


def left_join_variant(left: DataFrame, right: DataFrame, strategy: str | None = None) -> DataFrame:
    """Left join on (chrom, pos, ref, alt)."""
    return keyed_join(left, right, S.VARIANT_KEY, "left", strategy)


def join_locus_alt(left: DataFrame, right: DataFrame, how: str = "left", strategy: str | None = None) -> DataFrame:
    """Join on (chrom, pos, alt), for tables whose reference allele is written differently."""
    return keyed_join(left, right, S.LOCUS_ALT_KEY, how, strategy)


def annotate(
    variants: DataFrame,
    table: DataFrame,
    columns: Sequence[str] | dict[str, str],
    key: KeyList = ("chrom", "blk_pos", "var_id"),
    strategy: str | None = None,
) -> DataFrame:
    """Adds annotation columns by left join; a key listed twice in the table gives two rows.

    ``columns`` may map source to result names. Chained calls with one key hash the variants once.
    """
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    picked = table.select(*key, *[F.col(old).alias(new) for old, new in names.items()])
    return keyed_join(variants, picked, key, "left", strategy)


def annotate_dbsnp(variants: DataFrame, dbsnp: DataFrame, **options) -> DataFrame:
    return annotate(variants, dbsnp, ["rs_id", "dbsnp_buildid"], **options)


def annotate_kaviar(variants: DataFrame, kaviar: DataFrame, **options) -> DataFrame:
    return annotate(variants, kaviar, ["kav_freq", "kav_source"], **options)


def annotate_clinvar(variants: DataFrame, clinvar: DataFrame, **options) -> DataFrame:
    return annotate(variants, clinvar, ["clin_sig", "clin_dbn"], **options)


def annotate_hgmd(variants: DataFrame, hgmd: DataFrame, **options) -> DataFrame:
    return annotate(variants, hgmd, {"id": "hgmd_id", "var_class": "hgmd_varclass"}, **options)


def annotate_dbnsfp(variants: DataFrame, dbnsfp: DataFrame, **options) -> DataFrame:
    return annotate(variants, dbnsfp, ["cadd_raw", "dann_score", "interpro_domain"], **options)


def join_coding(
    variants: DataFrame,
    effects: DataFrame,
    how: str = "left",
    key: KeyList = ("chrom", "blk_pos", "var_id"),
    strategy: str | None = None,
) -> DataFrame:
    """Adds coding consequences; ``how="inner"`` drops variants without one."""
    return keyed_join(variants, effects, key, how, strategy)


def locate_genes(
    gene_list: DataFrame, genes: DataFrame, distinct: bool = True, strategy: str | None = None
) -> DataFrame:
    """Positions of the listed genes by name, one row per interval."""
    named = genes.withColumnRenamed("gene_name", "gene")
    located = keyed_join(gene_list, named, ["gene"], strategy=strategy)
    return located.distinct() if distinct else located


def join_gene_list(
    variants: DataFrame, gene_list: DataFrame, gene: str = "gene", strategy: str | None = None
) -> DataFrame:
    """Left join of gene-list columns by gene name."""
    return keyed_join(variants, gene_list.withColumnRenamed("gene", gene), [gene], "left", strategy)


def full_merge_variants(
    left: DataFrame, right: DataFrame, key: KeyList = S.VARIANT_KEY, where: Column | None = None
) -> DataFrame:
    """Distinct coalesced keys of a full outer join.

    A full outer join whose result is only its coalesced, deduplicated key equals the distinct union of both key
    sets. Written as the union, copies collapse before the one shuffle and a filter on the key (here or applied later)
    reaches both scans, which it cannot through an outer join.
    """
    merged = left.select(*key).unionByName(right.select(*key))
    return (merged if where is None else merged.where(where)).distinct()


def unmatched_ids(left: DataFrame, right: DataFrame, key: str, strategy: str | None = None) -> DataFrame:
    """Ids held by one side only, as (left_<key>, right_<key>)."""
    a = left.select(F.col(key).alias(f"left_{key}")).distinct()
    b = right.select(F.col(key).alias(f"right_{key}")).distinct()
    joined = a.join(with_strategy(b, strategy), F.col(f"left_{key}") == F.col(f"right_{key}"), "full")
    return joined.where(F.col(f"left_{key}").isNull() | F.col(f"right_{key}").isNull())


def _keys(right: DataFrame, on: KeyList, copies: bool, strategy: str | None) -> DataFrame:
    keys = right.select(*on)
    return with_strategy(keys.distinct() if copies else keys, strategy)


def members_in(
    left: DataFrame, right: DataFrame, on: KeyList, copies: bool = False, strategy: str | None = None
) -> DataFrame:
    """Rows whose key occurs in the other table. With ``copies`` the other table's keys are deduplicated first, which
    pays when it repeats them many times."""
    return left.join(_keys(right, on, copies, strategy), list(on), "left_semi")


def members_not_in(
    left: DataFrame, right: DataFrame, on: KeyList, copies: bool = False, strategy: str | None = None
) -> DataFrame:
    """Rows whose key does not occur in the other table; ``copies`` as in ``members_in``."""
    return left.join(_keys(right, on, copies, strategy), list(on), "left_anti")


def exists_predicates(
    left: DataFrame, right: DataFrame, on: KeyList, negate: bool = False, strategy: str | None = None
) -> DataFrame:
    """EXISTS / NOT EXISTS on an equality key."""
    return (members_not_in if negate else members_in)(left, right, on, strategy=strategy)


def merge_effects(
    variants: DataFrame, effects: DataFrame, key: str = "var_id", strategy: str | None = None
) -> DataFrame:
    """Variants with their effect columns, without repeated rows."""
    return keyed_join(variants, effects, [key], strategy=strategy).dropDuplicates()


def map_population(
    samples: DataFrame, panel: DataFrame, level: str = "super", unknown: str = "-", strategy: str | None = None
) -> DataFrame:
    """Known population of each sample at super or sub level; ``-`` when the sample is not in the panel."""
    column = {"super": "super_pop", "sub": "pop"}[level]
    known = panel.select("sample", F.col(column).alias("known_pop"))
    joined = keyed_join(samples, known, ["sample"], "left", strategy)
    return joined.withColumn("known_pop", F.coalesce("known_pop", F.lit(unknown)))


def attach_subject(
    results: DataFrame, metadata: DataFrame, vendor: str = "vendor_id", genome: str = "genome", strategy: str | None = None
) -> DataFrame:
    """Left columns plus the subject id found by vendor id."""
    lookup = metadata.select(F.col(genome).alias(vendor), "subject_id")
    return keyed_join(results, lookup, [vendor], "left", strategy)


def strata_join(calls: DataFrame, counts: DataFrame, strategy: str | None = None) -> DataFrame:
    """Subject genotypes with the reference allele count of their site; the calls' ``strata_id`` is the position."""
    return keyed_join(calls.withColumnRenamed("strata_id", "pos"), counts, ["chrom", "pos"], strategy=strategy)


def zip_columns(left: DataFrame, right: DataFrame, key: str, strategy: str | None = None) -> DataFrame:
    """Row-aligned frames side by side, aligned by an explicit key (a DataFrame has no row order)."""
    return keyed_join(left, right, [key], strategy=strategy)
