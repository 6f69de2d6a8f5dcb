"""A training corpus from ``documents``: five stages, each over all that the one before it kept.

Toxic documents go, one document of each group of near duplicates stays, documents that hold benchmark items go, the
rest is repeated or left out so that sources meet their weights, and what remains is dealt into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.decontaminate import contaminated
from varloom.llm.mixing import mixed
from varloom.llm.near_dedup import near_duplicates
from varloom.llm.queries import remainder
from varloom.llm.sharding import sharded
from varloom.llm.toxicity import toxicity
from varloom.session import stage


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose doc_id is not among ``ids``; a null doc_id stays."""
    gone = ids.where("doc_id is not null").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts to be toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, labels, learn=remainder(3) != 1)
    return without(docs, stage(scored.where("predicted = 1").select("doc_id"), "toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest doc_id; repeated rows of it too."""
    return without(docs, near_duplicates(docs).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as many times as the mix takes it; rows of one doc_id share the largest number."""
    copies = mixed(docs).where("copies > 0").groupBy(F.col("doc_id").alias("__mixed_id")).agg(F.max("copies").alias("__mixed_copies"))
    taken = docs.join(copies, docs["doc_id"].eqNullSafe(copies["__mixed_id"]))
    repeated = taken.withColumn("__mixed_id", F.explode(F.sequence(F.lit(1), F.col("__mixed_copies").cast("int"))))
    return repeated.select(*[docs[c] for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in the sharded corpus."""
    return sharded(docs)


STAGES = [("toxicity", toxic_out), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: Trained models and iteration are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
