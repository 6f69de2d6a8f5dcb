"""File readers. Text formats take a schema, so no file is read twice to infer one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_csv", "read_libsvm", "read_lines", "read_numeric_lines", "read_tsv", "read_variants", "register_table"]


def register_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Parquet folder as a named view; also returned."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def read_variants(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Partitioned variant Parquet. Legacy binary text reads as string, and ``chrom`` stays text.

    Without a schema the chromosome folder names alone would make an integer column of chromosomes 1-22.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)} | ({"chrom"} & set(df.columns))
    return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c in text})


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    comment: str | None = "#",
    columns: Sequence[str] | None = None,
    header: bool = False,
    sep: str = "\t",
) -> DataFrame:
    """Delimited text without a header (or with one to skip), comment lines dropped, optionally some columns only."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if comment:
        reader = reader.option("comment", comment)
    df = reader.csv(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated text with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_lines(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """One row per text line."""
    return spark.read.text(path).withColumnRenamed("value", name)


def read_numeric_lines(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated numbers, each line as a double array ``values``; blank lines dropped."""
    text = F.trim("value")
    return spark.read.text(path).where(text != "").select(F.split(text, r"\s+").cast("array<double>").alias("values"))


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """LibSVM file as (label, features). Giving the feature count saves a pass over the file."""
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", str(features))
    return reader.load(path)
