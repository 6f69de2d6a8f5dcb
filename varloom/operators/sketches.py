"""Distinct-sample counts for cohorts that grow: HyperLogLog sketches per group, stored, merged and read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom import schema as S

#: 2^14 registers: a standard error of 0.8 percent, at most about 16 kB a sketch; small groups are counted exactly.
LG_REGISTERS = 14


def sample_sketches(
    calls: DataFrame, keys: Sequence[str] = S.PARTITION_COLUMNS, sample: str = "sample_id", lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """One sketch of the distinct samples per group; null samples do not count. Partial sketches are made before the shuffle."""
    return calls.groupBy(*keys).agg(F.hll_sketch_agg(sample, lg_registers).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, or of everything. Merging in steps or at once gives the same sketch."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_samples(sketches: DataFrame, name: str = "n_samples") -> DataFrame:
    """The sketch of each row replaced by its estimate.

    A sketch that has taken in values one by one is estimated from the order it met them in. Its union with itself is estimated
    from its registers alone, so the ways to merge the same sketches agree.
    """
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.hll_sketch_estimate(F.hll_union("sketch", "sketch")).alias(name))


def add_sketches(calls: DataFrame, path: str, keys: Sequence[str] = S.PARTITION_COLUMNS, **options) -> None:
    """Adds the sketches of a batch of calls to a stored sketch table; older calls are not read.

    A merge takes the union, so a batch that is added again after a failure changes no count.
    """
    sample_sketches(calls, keys, **options).write.mode("append").parquet(path)


def stored_samples(spark: SparkSession, path: str, keys: Sequence[str] = (), schema: str | None = None) -> DataFrame:
    """Estimated distinct samples per group over all batches of a stored sketch table."""
    rows = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    return estimated_samples(merge_sketches(rows, keys))
