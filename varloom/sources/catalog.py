"""Catalog browsing, statistics, external tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.operators.aggregates import distinct_variants
from varloom.operators.joins import full_merge_variants, members_in
from varloom.schema import VARIANT_KEY

__all__ = ["compute_stats", "describe_tables", "external_tsv_table", "variant_union_view", "variant_view"]


def external_tsv_table(spark: SparkSession, name: str, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Table over delimited files that stay where they are."""
    return spark.catalog.createTable(name, path=path, source="csv", schema=schema, sep=sep)


def variant_view(df: DataFrame, name: str) -> DataFrame:
    """Pass-through view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def variant_union_view(
    left: DataFrame, right: DataFrame, name: str, both: bool = False, chrom: str | None = None
) -> DataFrame:
    """View of the merged distinct variants of two tables.

    By default a variant of either table belongs to it. ``chrom`` puts a chromosome filter inside the view, and
    ``both`` asks for it on both sides of the merge, which leaves the variants the tables share.
    """
    where = None if chrom is None else F.col("chrom") == chrom
    if both:
        shared = members_in(distinct_variants(left), right, VARIANT_KEY)
        merged = shared if where is None else shared.where(where)
    else:
        merged = full_merge_variants(left, right, where=where)
    merged.createOrReplaceTempView(name)
    return left.sparkSession.table(name)


def describe_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Column listing (database, table, column, type) of one database, or of every database; temporary views included."""
    names = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    found = {}
    for name in names:
        for table in spark.catalog.listTables(name):
            place = "" if table.isTemporary else name
            for column in spark.catalog.listColumns(f"{place}.{table.name}" if place else table.name):
                found[(place, table.name, column.name)] = column.dataType
    rows = [(*key, kind) for key, kind in sorted(found.items())]
    return spark.createDataFrame(rows, "database string, table string, column string, type string")


def compute_stats(spark: SparkSession, table: str) -> None:
    """Table and column statistics for the cost-based optimizer."""
    spark.sql("ANALYZE TABLE IDENTIFIER(:name) COMPUTE STATISTICS FOR ALL COLUMNS", args={"name": table})
