"""Allele counts stored by load batch: a new batch adds its own counts, and frequencies follow without the older calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.statistics import _with_frequency


def batch_counts(dosages: DataFrame, marker: Sequence[str] = S.VARIANT_KEY, by: Sequence[str] = ()) -> DataFrame:
    """Alternate alleles and missing samples per marker, and per group of ``by``, of the samples of one batch.

    One dosage per sample and marker, null where its calls lack a genotype (``sample_dosages(.., missing=True)``).
    """
    return dosages.groupBy(*marker, *by).agg(
        F.coalesce(F.sum("dosage"), F.lit(0)).cast("long").alias("alt_alleles"), F.count_if(F.col("dosage").isNull()).alias("n_missing")
    )


def add_batch(
    dosages: DataFrame, samples: DataFrame, path: str, batch: str, marker: Sequence[str] = S.VARIANT_KEY, by: Sequence[str] = ()
) -> None:
    """Stores the counts and the cohort size of one batch; storing a batch again replaces it.

    ``samples`` has a row per sample of the batch, calls or none, first column its name, and the ``by`` columns; repeats count
    once. A sample belongs to one batch. With ``by`` only samples listed there take part.
    """
    name = samples.columns[0]
    listed = samples.where(F.col(name).isNotNull()).select(name, *by).distinct()
    sizes = listed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_batch"))
    if by:
        keyed = listed.withColumnRenamed(name, "__sample")
        sample = dosages.columns[0]
        dosages = dosages.join(keyed, dosages[sample] == keyed["__sample"]).drop("__sample")
    for part, rows in (("sizes", sizes), ("counts", batch_counts(dosages, marker, by))):
        writer = rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(f"{path}/{part}")


def stored_frequency(spark: SparkSession, path: str, marker: Sequence[str] = S.VARIANT_KEY, by: Sequence[str] = ()) -> DataFrame:
    """Allele frequency per marker, and per group, over the cohorts of all stored batches.

    The rows of ``dosage_frequency`` and ``population_frequency`` over all calls. One row per marker and batch is read.
    """
    counts, sizes = spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/sizes")
    summed = counts.groupBy(*marker, *by).agg(F.sum("alt_alleles").alias("alt_alleles"), F.sum("n_missing").alias("n_missing"))
    cohort = sizes.groupBy(*by).agg(F.sum("n_batch").alias("__size"))
    joined = summed.join(cohort, list(by)) if by else summed.withColumn("__size", F.lit(cohort.first()[0]))
    return _with_frequency(joined.select(*marker, *by, "alt_alleles", (F.col("__size") - F.col("n_missing")).cast("long").alias("n_samples")))
