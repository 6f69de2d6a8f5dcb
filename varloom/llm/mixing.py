"""Mixing sources to target weights: whole passes, then a bounded knapsack over document lengths for the rest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1024
#: Words left to the exact fit, after proportional and largest-first taking.
FIT_WORDS = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): ``share`` of all sizes by weight, at most ``most`` times the source.

    What a full source leaves over goes to the others by weight, so a target is min(cap, level * weight) for one common
    level. Weights repeat over the sources in code-point order, a null source last. One row per source is ordered here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    out = totals.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    out = out.withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    out = out.withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    out = out.withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    out = out.withColumn("level", (share * F.sum("source_size").over(whole) - F.col("spent")) / F.col("open"))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(whole)["level"]
    return out.withColumn("target", F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap"))).select(
        "source", "source_size", "target"
    )


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near under ``budget`` as they can.

    An even share of every length first, so that the choice follows the source's lengths; then the longest that still
    fit, until ``FIT_WORDS`` are left; the rest by a reachability table over sums (bits of one integer), each length
    split into lots of 1, 2, 4, .. documents.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths):
        if left <= FIT_WORDS:
            break
        n = min(int(counts[i] - taken[i]), (left - FIT_WORDS) // int(lengths[i]))
        taken[i] += n
        left -= n * int(lengths[i])
    mask = (1 << (left + 1)) - 1
    sums, history = 1, []
    for i in np.argsort(-lengths):
        free, lot = int(counts[i] - taken[i]), 1
        while free > 0 and not sums >> left & 1:
            n = min(lot, free)
            words = n * int(lengths[i])
            if words > left:
                break
            history.append((i, n, words, sums))
            sums = (sums | sums << words) & mask
            free, lot = free - n, lot * 2
    reached = sums.bit_length() - 1
    for i, n, words, before in reversed(history):
        if not before >> reached & 1:
            taken[i] += n
            reached -= words
    return taken


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 0
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    ``taken`` words = ``copies`` times the size; copies run from 0 to ``most``. Every source takes whole passes over its
    documents as far as its target allows; one more copy goes to documents chosen by length (``fit``) and, within a
    length, in the order of a seeded hash of doc_id. The lengths of a source meet as a histogram, never as documents; the
    order within a length is worked out in ``BUCKETS`` parts, so a source or length with most rows spreads over tasks.

    Null text and text without words: size 0, nothing taken. A null source is a source of its own. Rows that repeat a
    doc_id each count; equal rows tie and either may get the copy. Empty input gives no rows. Other columns are ignored.
    """
    h = F.xxhash64(F.lit(seed), "doc_id")
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    base = stage(base.withColumn("order", h).withColumn("bucket", F.pmod(h, F.lit(BUCKETS)).cast("int")), "mix-sizes")
    parts = stage(base.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "mix-parts")
    totals = parts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(totals, weights, share, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("passes", F.least(passes, F.lit(most)).cast("long"))
    goal = stage(goal.withColumn("budget", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "mix-goals")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        n = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["budget"].iloc[0]))
        return pdf[["source", "size"]].assign(extra=n)

    lengths = parts.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"))
    lengths = lengths.alias("l").join(goal.alias("g"), F.expr("l.source <=> g.source")).select("l.*", "budget")
    extra = stage(lengths.groupBy("source").applyInPandas(choose, "source string, size long, extra long"), "mix-lengths")
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    cut = cut.alias("c").join(extra.alias("e"), F.expr("c.source <=> e.source and c.size = e.size"))
    cut = stage(cut.select("c.*", F.greatest(F.col("extra") - F.col("before"), F.lit(0)).alias("open")), "mix-cuts")
    ranked = base.withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id")))
    ranked = ranked.alias("r").join(
        cut.alias("c"), F.expr("r.source <=> c.source and r.size = c.size and r.bucket = c.bucket"), "left"
    )
    ranked = ranked.select("r.*", F.coalesce("open", F.lit(0)).alias("open"))
    goal = F.broadcast(goal) if goal.count() <= 100_000 else goal
    out = ranked.join(goal.withColumnRenamed("source", "s"), F.expr("source <=> s"))
    copies = F.when(F.col("size") > 0, F.col("passes") + (F.col("rank") <= F.col("open")).cast("long")).otherwise(0).cast("long")
    copies = F.least(copies, F.lit(most).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))
