"""The annotated table of all distinct variants."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import with_ppc_rating, with_var_id, with_var_type
from varloom.operators import joins as J
from varloom.operators.aggregates import union_distinct_variants
from varloom.operators.bloom import KEYS_PER_SEGMENT, WORDS, build_filter, merge_filters, with_maybe
from varloom.operators.quality import check_not_shrunk
from varloom.operators.ranges import range_join
from varloom.session import stage
from varloom.sources.readers import read_variants
from varloom.sources.writers import insert_partitioned

# The union is deduplicated on exactly these columns and every annotation joins on them, so the distinct variants are
# shuffled once for the whole chain.
KEY = ["chrom", "blk_pos", "pos", "ref", "allele"]

FILTER_SCHEMA = "chrom string, blk_pos int, segments int, segment int, " + ", ".join(f"{w} long" for w in WORDS)

CODING_COLUMNS = ["effect", "impact", "feature", "feature_id", "biotype", "rank", "hgvs_c", "hgvs_p"]
GENE_COLUMNS = ["strand", "gene_name", "gene_id", "transcript_name", "transcript_id", "exon_name", "exon_number"]


def _present(table: DataFrame, names: Sequence[str]) -> list[str]:
    listed = table.columns
    return [c for c in names if c in listed]


def _by_allele(table: DataFrame) -> DataFrame:
    return table.withColumnRenamed("alt", "allele")


def annotate_variants(
    variants: DataFrame,
    *,
    dbsnp: DataFrame,
    kaviar: DataFrame,
    clinvar: DataFrame,
    hgmd: DataFrame,
    dbnsfp: DataFrame,
    coding: DataFrame,
    genes: DataFrame,
    start: str = "txstart",
    stop: str = "txstop",
    coding_how: str = "left",
) -> DataFrame:
    """Distinct variants with ids, frequency, significance, scores, consequence, gene and ratings.

    The interval join comes last, after all joins on the variant key, so it does not break their shared partitioning. Tables
    that are bucketed by that key are read where they lie (``sources.bucketed``).
    """
    steps = [
        (J.annotate_dbsnp, dbsnp),
        (J.annotate_kaviar, kaviar),
        (J.annotate_clinvar, clinvar),
        (J.annotate_hgmd, hgmd),
        (J.annotate_dbnsfp, dbnsfp),
    ]
    for step, table in steps:
        variants = step(variants, _by_allele(table), key=KEY)
    effects = _by_allele(coding).select(*KEY, *_present(_by_allele(coding), CODING_COLUMNS))
    variants = J.join_coding(variants, effects, coding_how, key=KEY)
    located = genes.select("chrom", start, stop, *_present(genes, GENE_COLUMNS))
    variants = range_join(variants, located, "left", start=start, stop=stop).drop(start, stop)
    rated = with_ppc_rating(with_var_type(variants, alt="allele"), alt="allele")
    return with_var_id(rated, alt="allele")


def global_variants(sources: Sequence[DataFrame], **tables) -> DataFrame:
    """Distinct variants of all sources, annotated; ``tables`` and options as in ``annotate_variants``."""
    return annotate_variants(union_distinct_variants(*sources), **tables)


def checked_stage(variants: DataFrame, floor: int, **tables) -> DataFrame:
    """Staged distinct variants annotated and staged, after the check that annotation lost none of them.

    Both sides are counted on what has been written, so the sources are read once. (An observation on the write would save
    that first file, but a session that has used one can no longer send some ``pyspark.ml`` models to its tasks.)
    """
    built = stage(annotate_variants(variants, **tables), "global-variants")
    lost = check_not_shrunk(variants, built.select(*KEY).distinct(), floor).first()
    if lost is not None:
        raise ValueError(f"annotation left {lost['n_following']} of {lost['n_previous']} variants (at least {floor} expected)")
    return built


def write_global_variants(
    sources: Sequence[DataFrame], path: str, *, floor: int = 1000, mode: str = "overwrite", **tables
) -> DataFrame:
    """Builds the table, checks that annotation lost no variant, writes it by (chrom, blk_pos) and returns what is stored.

    The annotated rows are staged, so the check and the write read one result. A failed check raises and writes nothing.
    """
    built = checked_stage(stage(union_distinct_variants(*sources), "variants"), floor, **tables)
    insert_partitioned(built, path, mode=mode)
    return read_variants(built.sparkSession, path, built.schema)


# --- adding sources -------------------------------------------------------------------------------------------------
#
# A stored global table is a folder with the annotated rows (``rows``) and the Bloom filter of their keys (``filter``), one
# part per batch. A batch writes its filter part before its rows: a filter that holds too much only costs an exact look, one
# that holds too little would let a variant in twice. So a batch that died anywhere can simply be run again.


def _read_filter(spark, path: str) -> DataFrame:
    return spark.read.schema(FILTER_SCHEMA).parquet(f"{path}/filter")


def read_global(spark, path: str, schema=None) -> DataFrame:
    """The annotated rows of a stored global table."""
    return read_variants(spark, f"{path}/rows", schema)


def create_global(sources: Sequence[DataFrame], path: str, *, floor: int = 1000, per_segment: int = KEYS_PER_SEGMENT, **tables) -> DataFrame:
    """A new stored global table from the first sources; returns its rows."""
    spark = sources[0].sparkSession
    built = checked_stage(stage(union_distinct_variants(*sources), "variants"), floor, **tables)
    build_filter(built.select(*KEY).distinct(), KEY, per_segment).write.mode("overwrite").parquet(f"{path}/filter")
    insert_partitioned(built, f"{path}/rows", mode="overwrite")
    return read_global(spark, path, built.schema)


def unseen_variants(sources: Sequence[DataFrame], stored_keys: DataFrame, stored_filter: DataFrame, strategy: str | None = "broadcast") -> DataFrame:
    """Distinct variants of the sources that the stored table does not hold.

    Every source row is probed against the filter where it is read. Rows that are surely new skip the anti join; the others
    meet the stored keys, which decide, so a false positive of the filter changes nothing. Both branches are distinct and
    share no key, for a key has one answer.
    """
    columns = ["allele" if c == "alt" else c for c in S.BLOCK_KEY]
    aligned = [s.withColumnRenamed("alt", "allele").select(*columns) for s in sources]
    merged = stage(merge_filters(stored_filter), "filter")
    probed = stage(with_maybe(reduce(DataFrame.unionByName, aligned), merged, KEY, strategy).distinct(), "probed")
    new = probed.where(~F.col("maybe")).select(*KEY)
    maybe = probed.where("maybe").select(*KEY)
    held = stored_keys.select(*[F.col(c).alias(f"__{c}") for c in KEY])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEY]
    return new.unionByName(maybe.join(held, same, "left_anti"))


def extend_global(sources: Sequence[DataFrame], path: str, *, schema, per_segment: int = KEYS_PER_SEGMENT, strategy: str | None = "broadcast", **tables) -> DataFrame:
    """Adds the variants of further sources to a stored global table; returns all its rows.

    Only variants the table does not hold are annotated and appended; stored rows are neither rewritten nor annotated again, and
    of them only the keys are read. ``schema`` is that of the stored rows.
    """
    spark = sources[0].sparkSession
    held = read_global(spark, path, schema).select(*KEY)
    stored = _read_filter(spark, path)
    fresh = stage(unseen_variants(sources, held, stored, strategy), "unseen")
    build_filter(fresh, KEY, per_segment, known=stored).write.mode("append").parquet(f"{path}/filter")
    built = checked_stage(fresh, 0, **tables)
    insert_partitioned(built.select(*[f.name for f in schema.fields]), f"{path}/rows", mode="append")
    return read_global(spark, path, schema)


def rebuild_filter(spark, path: str, schema, per_segment: int = KEYS_PER_SEGMENT) -> None:
    """Adds a filter made anew from the stored keys, with room for all of them, to a table that has outgrown its first one."""
    made = build_filter(read_global(spark, path, schema).select(*KEY).distinct(), KEY, per_segment)
    made.write.mode("append").parquet(f"{path}/filter")
