"""Balanced label propagation: linked documents move to their neighbours' shard while shard sizes stay even."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.session import stage

PARTS = 256  # parts of a shard or flow whose counts the driver sees


def _part(seed: int, n: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"), F.lit(n)).cast("int")


def _limit(counts, keys: tuple, quota: dict) -> dict:
    """For each key the first part that may not move whole, so that what moves stays within the quota."""
    seen, limit = defaultdict(int), {}
    for row in sorted(counts, key=lambda r: r["part"]):
        key = tuple(row[k] for k in keys)
        seen[key] += row["n"]
        if seen[key] > quota.get(key, 0):
            limit.setdefault(key, row["part"])
    return limit


def _lookup(table: dict, *keys: str) -> Column:
    """A small table as a map column lookup."""
    if not table:
        return F.lit(None).cast("long")
    entries = [F.lit(x) for k, v in table.items() for x in ("/".join(map(str, k)), int(v))]
    return F.element_at(F.create_map(*entries), F.concat_ws("/", *[F.col(k).cast("string") for k in keys])).cast("long")


def _propagate(state: DataFrame, shards: int, room: dict, loads: dict, seed: int) -> tuple[DataFrame, int]:
    """One round: documents of a group that are not in its fullest shard ask to go there; flows are cut to quotas."""
    tally = state.where("linked").groupBy("link", "shard").agg(F.count("*").alias("n"))
    best = tally.groupBy("link").agg(
        F.max(F.struct("n", F.xxhash64(F.lit(seed), "link", "shard").alias("draw"), F.col("shard").alias("best"))).alias("b"),
        F.count("*").alias("spread"),
    )
    best = stage(best.where("spread > 1").select("link", "b.best"), "shard-best")
    asked = state.join(best, "link", "left").withColumn("part", _part(seed))
    asked = stage(asked.withColumn("best", F.when(F.col("best") != F.col("shard"), F.col("best"))), "shard-asked")
    # At most shards * shards * PARTS counts.
    flows = asked.where("best is not null").groupBy("shard", "best", "part").agg(F.count("*").alias("n")).collect()
    if not flows:
        return asked.drop("best", "part"), 0
    total = defaultdict(int)
    for r in flows:
        total[r["shard"], r["best"]] += r["n"]
    free = np.array([max(0, room[s] - loads.get(s, 0)) for s in range(shards)])
    flow = np.zeros((shards, shards))
    for (a, b), n in total.items():
        flow[a, b] = n
    # Flows into a shard shrink until what leaves it, with its free room, makes place for them.
    for _ in range(200):
        into, out = flow.sum(axis=0), flow.sum(axis=1)
        flow *= np.minimum(1, (out + free) / np.maximum(into, 1e-9))[None, :]
    limit = _limit(flows, ("best",), {(b,): int(flow[:, b].sum() + 1e-6) for b in range(shards)})
    goes = F.col("best").isNotNull() & (F.col("part") < F.coalesce(_lookup(limit, "best"), F.lit(PARTS)))
    moved = sum(r["n"] for r in flows if r["part"] < limit.get((r["best"],), PARTS))
    return asked.withColumn("shard", F.when(goes, F.col("best")).otherwise(F.col("shard"))).drop("best", "part"), moved


def _even(state: DataFrame, shards: int, room: dict) -> DataFrame:
    """Moves exactly the surplus of full shards to the others; documents whose move cuts no link go first."""
    tally = state.where("link is not null").groupBy("link", "shard").agg(F.count("*").alias("n"))
    tied = stage(tally.where("n > 1").select("link", "shard", F.lit(1).alias("tied")), "shard-tied")
    state = state.join(tied, ["link", "shard"], "left").withColumn("part", F.coalesce("tied", F.lit(0)) * PARTS + _part(-1))
    state = stage(state.drop("tied"), "shard-parts")
    counts = state.groupBy("shard", "part").agg(F.count("*").alias("n")).collect()
    loads = defaultdict(int)
    for r in counts:
        loads[r["shard"]] += r["n"]
    surplus = {(s,): loads[s] - room[s] for s in range(shards) if loads[s] > room[s]}
    if not surplus:
        return state.drop("part")
    start, seen, done = {}, defaultdict(int), 0
    for r in sorted(counts, key=lambda r: (r["shard"], r["part"])):
        key = (r["shard"],)
        if seen[key] < surplus.get(key, 0):
            start[r["shard"], r["part"]] = done  # place of the part's first document among all that move
            n = min(r["n"], surplus[key] - seen[key])
            start[r["shard"], r["part"], "n"] = n
            seen[key] += n
            done += n
    first = {k: v for k, v in start.items() if len(k) == 2}
    amount = {k[:2]: v for k, v in start.items() if len(k) == 3}
    inside = Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(-2), "doc_id"), "doc_id", "text_crc32", "size")
    state = state.withColumn("rank", F.row_number().over(inside))
    place = F.when(F.col("rank") <= _lookup(amount, "shard", "part"), _lookup(first, "shard", "part") + F.col("rank"))
    state = state.withColumn("place", place)
    target, upto = F.col("shard"), 0
    cases = []
    for s in range(shards):
        if loads[s] < room[s]:
            upto += room[s] - loads[s]
            cases.append((upto, s))
    for bound, s in reversed(cases):
        target = F.when(F.col("place") <= bound, F.lit(s)).otherwise(target)
    return state.withColumn("shard", target.cast("int")).drop("rank", "place", "part")


def sharded(docs: DataFrame, shards: int = 16, rounds: int = 10, seed: int = 0, link: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: the row counts of two shards differ by one at most. Documents are linked if ``link`` is equal (equal
    texts unless given; null links with nothing). They begin in a shard by a hash of doc_id; each round, those outside
    the fullest shard of their group move there as far as what leaves that shard and its free room allow. Groups are handled by their
    counts per shard, never as pairs; a group larger than a shard fills it and stays spread over others. The linked
    documents of a shard never exceed its size; the last step moves the exact surplus, unlinked documents first. The driver sees counts per shard and part only, a fixed number.

    ``size`` is the UTF-8 length plus 1 (null text: 1), ``text_crc32`` 0 for null. ``slot`` counts from 0 without gaps.
    ``grown_shard`` is null under this law. Repeated and null doc_ids are rows like others. Empty input: no rows.
    """
    text = F.col("text")
    own = F.xxhash64(F.lit(1), text).cast("string") if link is None else link.cast("string")
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    key = own if link is not None else F.when(text.isNotNull(), F.concat_ws("/", own, crc.cast("string"), size.cast("string")))
    first = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(shards)).cast("int")
    state = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), key.alias("link"), first.alias("shard"))
    state = stage(state, "shard-start")
    n = state.count()
    groups = state.where("link is not null").groupBy("link").agg(F.count("*").alias("n")).where("n > 1").select("link", F.lit(True).alias("linked"))
    state = stage(state.join(stage(groups, "shard-links"), "link", "left"), "shard-linked")
    room = {s: n // shards + (s < n % shards) for s in range(shards)}
    for r in range(rounds):
        # Only linked documents count here: the others give way in the last step.
        loads = {x["shard"]: x["n"] for x in state.where("linked").groupBy("shard").agg(F.count("*").alias("n")).collect()}
        state, moved = _propagate(state, shards, room, loads, seed + 1 + r)
        state = stage(state, "shard-round")
        if not moved:
            break
    state = stage(_even(state, shards, room), "shard-even")
    parts = max(64, n // (shards * 4096))
    state = state.withColumn("part", _part(-3, parts))
    counts = state.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "shard-slots")
    inside = Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(-4), "doc_id"), "doc_id", "text_crc32", "size")
    state = state.withColumn("rank", F.row_number().over(inside)).join(starts, ["shard", "part"])
    return state.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("start") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
