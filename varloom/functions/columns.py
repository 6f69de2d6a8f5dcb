"""Derived columns. Each ``with_*`` adds one column; all stay inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.hints import with_strategy

__all__ = [
    "add_chr_prefix", "adjusted_mac", "allele_flags", "clean_gene_list", "date_stamp", "dosage", "genotype_dosage",
    "locus_text", "missing_ids", "normalize_gt", "reorder_id_parts", "report_key", "strip_chr_prefix", "tidy_columns",
    "with_alt_call", "with_blk_pos", "with_clin_patho", "with_family_id", "with_kaviar_rare", "with_member",
    "with_member_lookup", "with_ppc_rating", "with_predicted_damaging", "with_var_id", "with_var_type",
]


def _label(condition: Column) -> Column:
    """Y / N text label; an unknown condition is N."""
    return F.when(condition, "Y").otherwise("N")


def with_var_id(df: DataFrame, name: str = "var_id", alt: str = "alt") -> DataFrame:
    """Variant id ``chrom:pos:ref:alt``."""
    return df.withColumn(name, F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", alt))


def locus_text(*parts: str) -> Column:
    """Colon-separated locus text, as ``chrom:start:stop``."""
    return F.concat_ws(":", *[F.col(p).cast("string") for p in parts])


def report_key(gene: str, chrom: str, ref: str, allele: str, sample: str) -> Column:
    """Key of a reported finding: ``gene:chrom:ref->allele:sample``."""
    return F.concat_ws(":", gene, chrom, F.concat(F.col(ref), F.lit("->"), F.col(allele)), sample)


def with_blk_pos(df: DataFrame, width: int = S.BLOCK_WIDTH, pos: str = "pos", name: str = "blk_pos") -> DataFrame:
    """Position block: the integer part of pos / width."""
    return df.withColumn(name, F.floor(F.col(pos) / width).cast("int"))


def with_var_type(df: DataFrame, ref: str = "ref", alt: str = "alt") -> DataFrame:
    """deletion / insertion / snv by allele lengths; other when a length is unknown."""
    r, a = F.length(ref), F.length(alt)
    return df.withColumn(
        "var_type",
        F.when(r > a, "deletion").when(r < a, "insertion").when(r == a, "snv").otherwise("other"),
    )


def with_ppc_rating(
    df: DataFrame, effects: Mapping = S.PPC_EFFECTS, ref: str = "ref", alt: str = "alt", effect: str = "effect"
) -> DataFrame:
    """Protein-consequence rating from the length rule and the effect name."""
    r, a, e = F.length(ref), F.length(alt), F.col(effect)
    shifted = (r != a) & (e == effects["frameshift"])
    changed = (
        ((r == a) & e.isin(*effects["equal"]))
        | ((r > a) & (e == effects["deletion_inframe"]))
        | ((r < a) & (e == effects["insertion_inframe"]))
    )
    return df.withColumn(
        "ppc_rating",
        F.when(shifted, "frameshift-non-synonymous").when(changed, "non-synonymous").otherwise("synonymous"),
    )


def with_kaviar_rare(df: DataFrame, threshold: float = 0.03, freq: str = "kav_freq") -> DataFrame:
    """Y when the population frequency is under the threshold or the variant is not listed."""
    return df.withColumn("kaviar_rare", _label((F.col(freq) < threshold) | F.col(freq).isNull()))


def pathogenic(sig: Column, patterns: Mapping[str, str] = S.PATHOGENIC_STRICT) -> Column:
    """True when the code list has 4 or 5 and never 2 or 3; null for a null list."""
    return ~sig.rlike(patterns["never"]) & sig.rlike(patterns["has"])


def with_clin_patho(
    df: DataFrame, sig: str = "clin_sig", patterns: Mapping[str, str] = S.PATHOGENIC_STRICT
) -> DataFrame:
    """Y for an unconflicted pathogenic significance."""
    return df.withColumn("clin_patho", _label(pathogenic(F.col(sig), patterns)))


def with_predicted_damaging(
    df: DataFrame, dann: float | None = None, calls: Mapping[str, str] = S.DAMAGING_CALLS
) -> DataFrame:
    """Y when any predictor present in ``df`` reports its damaging letter or the DANN score reaches the cutoff."""
    listed = df.columns
    tests = [F.col(name).contains(letter) for name, letter in calls.items() if name in listed]
    if dann is not None:
        tests.append(F.col("dann_score") >= dann)
    return df.withColumn("predicted_damaging", _label(reduce(or_, tests, F.lit(False))))


def with_member(df: DataFrame, suffixes: Mapping[str, str] = S.MEMBER_SUFFIXES, sample: str = "sample_id") -> DataFrame:
    """Trio member from the last two characters of the sample id; null when no suffix fits."""
    tail = F.substring(sample, -2, 2)
    member = reduce(lambda acc, kv: acc.when(tail == kv[1], kv[0]), suffixes.items(), F)
    return df.withColumn("member", member)


def with_member_lookup(df: DataFrame, members: DataFrame, strategy: str | None = None) -> DataFrame:
    """Trio member from a table (sample_id, member), for ids without a regular suffix."""
    return df.join(with_strategy(members.select("sample_id", "member"), strategy), "sample_id", "left")


def with_family_id(
    df: DataFrame, drop_last: int | None = 3, start: int | None = None, sample: str = "sample_id"
) -> DataFrame:
    """Family id cut from the sample id: without its last characters, or from character ``start`` on."""
    text = F.col(sample)
    if start is not None:
        family = text.substr(F.lit(start), F.length(text))
    else:
        family = text.substr(F.lit(1), F.length(text) - drop_last)
    return df.withColumn("family_id", family)


def with_alt_call(df: DataFrame, alt: str = "alt", first: str = "allele1seq", second: str = "allele2seq") -> DataFrame:
    """hom_alt when both called alleles equal alt, hom_ref when neither does, else other."""
    a, x, y = F.col(alt), F.col(first), F.col(second)
    call = F.when((a == x) & (a == y), "hom_alt").when((a != x) & (a != y), "hom_ref").otherwise("other")
    return df.withColumn("alt_call", call)


def allele_flags(df: DataFrame, alleles: Sequence[str] = ("allele1seq", "allele2seq"), ref: str = "ref") -> DataFrame:
    """Adds ``<n>_alt_count``: 1 when an allele differs from the reference, else 0."""
    flags = {f"allele{i}_alt_count": F.when(F.col(a) != F.col(ref), 1).otherwise(0) for i, a in enumerate(alleles, 1)}
    return df.withColumns(flags)


def normalize_gt(df: DataFrame, gt: str = "gt") -> DataFrame:
    """Rewrites genotype 1/2 as 0/1."""
    return df.withColumn(gt, F.regexp_replace(gt, "1/2", "0/1"))


def genotype_dosage(gt: str = "gt") -> Column:
    """Alternate-allele count of a genotype: 1/1 is 2, another called genotype 1, 0/0 is 0, missing null."""
    return F.when(F.col(gt) == "1/1", 2).when(F.col(gt) == "0/0", 0).when(F.col(gt).isNotNull(), 1)


def dosage(df: DataFrame, gt: str = "gt") -> DataFrame:
    return df.withColumn("dosage", genotype_dosage(gt))


def add_chr_prefix(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    return df.withColumn(chrom, F.concat(F.lit("chr"), chrom))


def strip_chr_prefix(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Removes a leading chr in any case and renames MT to M."""
    bare = F.regexp_replace(chrom, "^(?i)chr", "")
    return df.withColumn(chrom, F.when(F.upper(bare) == "MT", "M").otherwise(bare))


def adjusted_mac(df: DataFrame, seed: int, total: int = S.PANEL_ALLELES) -> DataFrame:
    """Allele count as a percentage of the panel, with seeded jitter in [0, 1); the exact share stays beside it."""
    return df.withColumns(
        {
            "mac_share": F.col("mac") / total * 100,
            "adj_mac": (F.col("mac") + F.rand(seed)) / total * 100,
        }
    )


def clean_gene_list(df: DataFrame, level: Column | None = None) -> DataFrame:
    """Import form of a gene list: ``,`` and ``;`` become ``:`` in text, names lose specials, a level column is added."""
    level = F.lit(None).cast("string") if level is None else level
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}

    def cleaned(name: str) -> Column:
        column = F.col(f"`{name}`")
        return F.translate(column, ",;", "::") if name in text else column

    return df.select(*[cleaned(c).alias(re.sub(r"\W", "", c.replace(" ", "_"))) for c in df.columns], level.alias("level"))


def reorder_id_parts(df: DataFrame, order: Sequence[int] = (2, 3, 1), sample: str = "sample_id") -> DataFrame:
    """Rearranges dash-separated id parts (1-based): F-101-758 becomes 101-758-F."""
    parts = F.split(F.col(sample), "-")
    return df.withColumn(sample, F.concat_ws("-", *[F.get(parts, F.lit(i - 1)) for i in order]))


def missing_ids(df: DataFrame, rs_id: str = "rs_id", build: str = "b37") -> DataFrame:
    """Fills a missing variant id with ``chrom:pos[build]ref,alt``."""
    pattern = F.concat(
        F.col("chrom"), F.lit(":"), F.col("pos").cast("string"), F.lit(f"[{build}]"), F.col("ref"), F.lit(","), F.col("alt")
    )
    return df.withColumn(rs_id, F.coalesce(rs_id, pattern))


def date_stamp(pattern: str = "yyMMdd") -> Column:
    """Today as text, for output names."""
    return F.date_format(F.current_date(), pattern)


def tidy_columns(
    df: DataFrame,
    order: Sequence[str] | None = None,
    drop_suffix: str | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drops columns by suffix, renames, then keeps ``order`` in that order."""
    kept = [c for c in df.columns if not (drop_suffix and c.endswith(drop_suffix))]
    out = df.select(*kept).withColumnsRenamed(dict(rename or {}))
    return out.select(*order) if order else out
