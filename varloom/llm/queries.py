"""The numbered queries over the driver's tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.chat import ORACLE as chat_sql
from varloom.llm.chat import maximal_chats
from varloom.llm.decontaminate import contaminated
from varloom.llm.langid import identify
from varloom.llm.lattice import near_vectors
from varloom.llm.lexical import ORACLE as lexical_sql
from varloom.llm.lexical import ranked_documents
from varloom.llm.line_rules import ORACLE as line_rules_sql
from varloom.llm.line_rules import cleaned_lines, let, words_in
from varloom.llm.lines import duplicate_lines
from varloom.llm.lmscore import scored
from varloom.llm.mixing import mixed
from varloom.llm.near_dedup import near_duplicates
from varloom.llm.periods import periodic_runs
from varloom.llm.sharding import sharded
from varloom.llm.toxicity import toxicity

QUERIES = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def remainder(n: int):
    """crc32 of the doc_id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=remainder(3) != 1)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "n_restored")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


@query
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"), learn=remainder(4) != 2)
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), learn=remainder(10) != 0)
    held_out = F.coalesce(remainder(10) == 0, F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_chats(table(spark, sf_dir, "conversations"))


ORACLES["op6_chat"] = chat_sql


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_lines(table(spark, sf_dir, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by hash the words from a place on repeat the p words there.

    With h = crc32 of the doc_id as text, g = h div 10 and n words: where h mod 10 is 0 and n > 0, word i >= a becomes word
    a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        place = lambda i, a, p: F.when(i >= a, a + F.pmod(i - a, p)).otherwise(i).cast("int")
        changed = let(F.struct(a.alias("a"), p.alias("p")), lambda s: F.transform(w, lambda _, i: F.get(w, place(i, s["a"], s["p"]))))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(changed, " "))

    planted = let(words_in(F.coalesce("text", F.lit(""))), repeated)
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs come by start, then period: only a greater exponent replaces the one held.
    higher = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    best = F.aggregate("runs", none, lambda best, x: F.when(higher(best, x), x).otherwise(best))
    line = lambda x: F.concat_ws(",", *[x[c].cast("string") for c in ("start", "length", "period")])
    listed = F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words"]
    return cleaned_lines(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept")


ORACLES["op12_quality_rules"] = line_rules_sql


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_lexical_search"] = lexical_sql
