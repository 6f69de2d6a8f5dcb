"""Tables stored in buckets of the variant key, sorted inside, so that keyed joins need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from varloom.operators.hints import table_bytes

__all__ = ["ALLELE_KEY", "bucket_count", "read_bucketed", "save_bucketed"]

#: The columns the annotation joins use, in their order; tables that are to be joined share key, order and number of buckets.
ALLELE_KEY = ["chrom", "blk_pos", "pos", "ref", "allele"]
BUCKET_BYTES = 256_000_000
SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """A power of two for which a bucket holds about ``bucket_bytes``; measured on the largest table, used for all."""
    size, n = table_bytes(df), least
    while n * bucket_bytes < size:
        n *= 2
    return n


def save_bucketed(
    df: DataFrame, name: str, buckets: int, key: Sequence[str] = ALLELE_KEY, path: str | None = None
) -> DataFrame:
    """Stores a table in buckets of ``key``, one sorted file each, and returns it as stored; ``alt`` is renamed ``allele``.

    Rows are dealt by the hash that buckets use before they are written, so every task writes one file. Rows with null key
    columns are kept. A table of that name is replaced.
    """
    named = df.withColumnRenamed("alt", "allele") if "allele" in key else df
    writer = named.repartition(buckets, *key).write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return read_bucketed(df.sparkSession, name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A bucketed table. Joins on its whole key read it bucket by bucket, without shuffle; as each bucket is one sorted file, the
    session is told to trust that order, so there is no sort either."""
    if spark.conf.get(SORTED_SCAN) != "true":
        spark.conf.set(SORTED_SCAN, "true")
    return spark.table(name)
