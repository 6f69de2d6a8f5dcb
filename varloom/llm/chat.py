"""Chat formatting: logged conversations that prefix longer ones collapse, the rest is rendered. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.session import stage

PART = 256  # turns rendered into one text, and turns numbered together
HALVES = ["s1", "s2", "s3", "s4"]


def _halves(seed: int, *what: Column) -> list[Column]:
    h = F.xxhash64(F.lit(seed), *what)
    return [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]


def maximal_chats(conversations: DataFrame, part: int = PART) -> DataFrame:
    """One row per rendered part: conv_id, part, n_turns, copies, text.

    The turns of a conversation are numbered by turn (then role and text; null turns last; equal rows count once). The
    key of a prefix is its length with four sums over hashes of (number, role, text), a rolling hash in which a turn adds
    to what came before. A conversation goes if its whole key is a prefix key of one with more turns; of equal ones the
    smallest conv_id stays and ``copies`` counts them. Both are decided on distinct keys by an anti-join, so many copies
    or one common first turn cost one row. Numbers and sums are worked out in stretches of ``PART`` turn values and shifted
    by the totals of earlier stretches, and ``part`` numbers texts of at most ``part`` turns each, so that a
    conversation of any length spreads over tasks; parts in order make up the whole.

    Null roles and texts are turns of their own, rendered empty. ``<|`` inside a text or role becomes ``< |``. Rows
    without conv_id belong to no conversation and are left out. Empty input gives no rows; other columns are ignored.
    """
    turns = conversations.where("conv_id is not null").select("conv_id", F.col("turn").cast("long"), "role", "text").distinct()
    turns = turns.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / PART), F.lit((1 << 62))).cast("long"))
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_last("turn"), "role", "text")
    turns = stage(turns.withColumn("rank", F.row_number().over(inside)), "chat-turns")
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = turns.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    sizes = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    what = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    numbered = turns.join(sizes, ["conv_id", "stretch"]).withColumn("place", F.col("before") + F.col("rank")).drop("before", "rank")
    hashes = [*_halves(1, F.col("place"), *what), *_halves(2, F.col("place"), *what)]
    numbered = stage(numbered.withColumns(dict(zip(HALVES, hashes, strict=True))), "chat-numbered")

    sums = [F.sum(s).alias(s) for s in HALVES]
    whole = numbered.groupBy("conv_id").agg(F.count("*").alias("place"), *sums)
    distinct = whole.groupBy("place", *HALVES).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    distinct = stage(distinct, "chat-distinct")
    running = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    totals = numbered.groupBy("conv_id", "stretch").agg(*sums)
    shifts = totals.select("conv_id", "stretch", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in HALVES])
    prefixes = numbered.select("conv_id", "stretch", "place", *[F.sum(s).over(running).alias(s) for s in HALVES])
    prefixes = prefixes.join(shifts, ["conv_id", "stretch"]).select("place", *[(F.col(s) + F.col(f"{s}_before")).alias(s) for s in HALVES])
    met = prefixes.groupBy("place", *HALVES).agg(F.count("*").alias("met"))
    # A prefix key met more often than it is a whole key continues in some longer conversation.
    longer = distinct.join(met, ["place", *HALVES]).where("met > copies").select("conv_id")
    kept = distinct.join(longer, "conv_id", "left_anti").select("conv_id", F.col("place").alias("n_turns"), "copies")

    plain = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    said = F.concat(F.lit("<|"), plain(F.col("role")), F.lit("|>\n"), plain(F.col("text")), F.lit("<|end|>\n"))
    lines = numbered.join(kept, "conv_id").select(
        "conv_id", F.floor((F.col("place") - 1) / part).alias("part"), "n_turns", "copies", F.struct("place", said.alias("said")).alias("line")
    )
    lines = lines.groupBy("conv_id", "part").agg(F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.collect_list("line").alias("lines"))
    text = F.array_join(F.transform(F.sort_array("lines"), lambda x: x["said"]), "")
    return lines.select("conv_id", "part", "n_turns", "copies", text.alias("text"))


ORACLE = f"""
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n, list({{'r': role, 't': text}} ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS l
  FROM d GROUP BY conv_id
),
u AS (SELECT l, n, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY l, n),
m AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u v WHERE v.n > u.n AND v.l[1] = u.l[1] AND v.l[1:u.n] = u.l)),
s AS (
  SELECT conv_id, n, copies, i,
    '<|' || replace(coalesce(l[i].r, ''), '<|', '< |') || '|>' || chr(10) || replace(coalesce(l[i].t, ''), '<|', '< |') || '<|end|>' || chr(10) AS said
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM m)
)
SELECT conv_id, CAST((i - 1) // {PART} AS BIGINT) AS part, n AS n_turns, copies, string_agg(said, '' ORDER BY i) AS text
FROM s GROUP BY 1, 2, 3, 4
"""
