"""Sinks: VCF text, reports, partitioned Parquet and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import date_stamp
from varloom.operators.effects import tab_line

__all__ = ["insert_partitioned", "load_effects", "materialize", "save_rows", "write_report", "write_variants", "write_vcf"]


def write_vcf(rows: DataFrame, path: str) -> None:
    """VCF text in genome order, header first.

    The header travels as rows that sort before all others, so a range sort of the whole file places it at the start of
    the first part and no single task handles the body.
    """
    spark = rows.sparkSession
    titles = F.lit("#" + "\t".join(rows.columns))
    header = F.array(*[F.replace(F.lit(h), F.lit("{date}"), date_stamp()) for h in S.VCF_HEADER], titles)
    top = spark.range(1).select(F.posexplode(header).alias("pos", "line"))
    top = top.select(F.lit(-1).alias("rank"), F.col("pos").cast("long"), "line")
    place = F.array_position(F.array(*[F.lit(c) for c in S.CHROMOSOMES]), F.col("CHROM"))
    rank = F.when(place > 0, place).otherwise(len(S.CHROMOSOMES) + 1).cast("int")
    body = rows.select(rank.alias("rank"), F.col("POS").cast("long").alias("pos"), tab_line(rows.columns).alias("line"))
    top.unionByName(body).orderBy("rank", "pos", "line").select("line").write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited report with a header line; ``mode="append"`` adds to an existing one."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_variants(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def _balanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together for few files; oversized partitions are split and small ones merged."""
    return df.hint("rebalance", *keys)


def insert_partitioned(
    df: DataFrame, path: str, keys: Sequence[str] = S.PARTITION_COLUMNS, mode: str = "overwrite"
) -> None:
    """Writes into (chrom, blk_pos) folders.

    By default only the partitions present are replaced, so a rerun is safe; ``mode="append"`` adds rows to them.
    """
    writer = _balanced(df, keys).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(*keys).parquet(path)


def load_effects(effects: DataFrame, path: str) -> None:
    """Parsed effects as a partitioned table."""
    insert_partitioned(effects, path)


def materialize(df: DataFrame, name: str, replace: bool = True, path: str | None = None) -> DataFrame:
    """Result as a table: replaced, or kept as it is when it exists and ``replace`` is off. Returns the stored table."""
    spark = df.sparkSession
    if replace or not spark.catalog.tableExists(name):
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def save_rows(df: DataFrame, name: str, append: bool = False, path: str | None = None) -> None:
    """Frame as a new table, or its rows added to an existing one."""
    writer = df.write.mode("append" if append else "errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
