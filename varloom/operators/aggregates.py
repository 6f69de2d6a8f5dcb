"""Counts, grouped reports, ordering and set operations.

Every grouped result uses aggregates with a partial step, so a hot key is reduced on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.session import stage


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_distinct_samples(df: DataFrame, sample: str = "sample_id", approximate: bool = False) -> DataFrame:
    """Number of different samples, exact by default."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col(sample)).alias("n_samples"))


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_chrom(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    return count_by(df, chrom)


def groups_below(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Groups with fewer than ``n`` rows."""
    return count_by(df, *keys).where(F.col("n") < n)


def groups_above(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Groups with more than ``n`` rows."""
    return count_by(df, *keys).where(F.col("n") > n)


def distinct_variants(df: DataFrame, key: Sequence[str] = S.VARIANT_KEY) -> DataFrame:
    return df.select(*key).distinct()


def summarize_findings(df: DataFrame, result_class: str = "var_class", by: str = "phenotype") -> DataFrame:
    """Per result class: the total, the count of each condition and the count of each affected gene.

    Rows (class, section, value, n), all from one aggregation.
    """
    sections = F.array(
        *[
            F.struct(F.lit(section).alias("section"), value.alias("value"))
            for section, value in (
                ("total", F.lit("all")),
                (by, F.col(by)),
                ("gene", F.col("gene")),
            )
        ]
    )
    listed = df.select(F.col(result_class), F.inline(sections))
    return count_by(listed, result_class, "section", "value")


# --- order and limit ------------------------------------------------------------------------------------------------


def order_desc(df: DataFrame, column: str, pattern: str, by: str, then: Sequence[str] = ()) -> DataFrame:
    """Rows with ``column`` LIKE ``pattern``, highest ``by`` first.

    ``then`` breaks ties, so that the sort can split the rows of one chromosome over tasks.
    """
    return df.where(F.col(column).like(pattern)).orderBy(F.desc(by), *then)


def preview(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(*key).limit(n)


def sort_panel(panel: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Panel by super population, population, sample; ``columns`` picks those of a two-column population file."""
    ordered = panel.orderBy("super_pop", "pop", "sample")
    return ordered.select(*columns) if columns else ordered


def marker_list(df: DataFrame) -> DataFrame:
    """Distinct (chrom, pos) in order, with the chr prefix."""
    markers = df.select(F.concat(F.lit("chr"), "chrom").alias("chrom"), "pos").distinct()
    return markers.orderBy("chrom", "pos")


def sort_by_reference(
    df: DataFrame, reference: DataFrame, key: str = "sample", rank: str = "rank", then: Sequence[str] = ()
) -> DataFrame:
    """Rows in the order another table gives their key; ``then`` breaks ties and lets a hot key span sort partitions."""
    return df.join(reference.select(key, rank), key).orderBy(rank, *then)


# --- set operations -------------------------------------------------------------------------------------------------


def union_distinct_variants(*tables: DataFrame, key: Sequence[str] = S.BLOCK_KEY) -> DataFrame:
    """Distinct union of variant tables. ``alt`` is an accepted spelling of ``allele``; the result says ``allele``."""
    columns = ["allele" if c == "alt" else c for c in key]
    aligned = [t.withColumnRenamed("alt", "allele").select(*columns) for t in tables]
    return reduce(DataFrame.unionByName, aligned).distinct()


def concat_findings(**classes: DataFrame) -> DataFrame:
    """All result classes in one table, labelled ``var_class``; ``from_parent`` is NA where a class has none."""
    labelled = [df.withColumn("var_class", F.lit(name)) for name, df in classes.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
    if "from_parent" not in merged.columns:
        return merged.withColumn("from_parent", F.lit("NA"))
    return merged.withColumn("from_parent", F.coalesce("from_parent", F.lit("NA")))


def append_subject(panel: DataFrame, subject: str) -> DataFrame:
    """(family, sample) list with one more subject, whose family is itself."""
    row = panel.sparkSession.range(1).select(
        *[F.lit(subject).cast(panel.schema[c].dataType).alias(c) for c in ("family", "sample")]
    )
    return panel.select("family", "sample").unionByName(row)


def merge_genotypes(reference: DataFrame, subject: DataFrame, site: Sequence[str] = S.VARIANT_KEY) -> DataFrame:
    """Both genotype sets, kept to the markers they share.

    The sets are stored together with their origin, so each is computed once; a marker with both origins is shared. The
    shared markers are staged too: their size is then known, so that few of them meet the sets without a shuffle.
    """
    sets = [df.select(*reference.columns, F.lit(i).alias("__set")) for i, df in enumerate((reference, subject))]
    both = stage(sets[0].unionByName(sets[1]), "genotypes")
    origins = both.groupBy(*site).agg(F.min("__set").alias("a"), F.max("__set").alias("b"))
    shared = stage(origins.where("a < b").select(*site), "shared")
    return both.join(shared, list(site), "left_semi").select(*reference.columns)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left table whose values are nowhere in the right one; copies stay or go together, nulls are equal."""
    names = left.columns
    other = right.select(*[F.col(c).alias(f"__r{i}") for i, c in enumerate(names)])
    same = [left[c].eqNullSafe(other[f"__r{i}"]) for i, c in enumerate(names)]
    return left.join(other, same, "left_anti")
