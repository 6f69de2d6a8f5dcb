"""Bloom filter of variant keys as a table, built, merged and probed with SQL functions only.

Keys of one position block are dealt by hash into segments of 512 bits, eight words of 64. A key sets one bit in each
word of its segment, so a filter row is eight numbers, a build is one aggregate with partial bit sums, two filters merge
by the same aggregate, and a probe is eight comparisons on the row that meets its segment.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.hints import with_strategy

WORDS = [f"w{i}" for i in range(8)]
KEYS_PER_SEGMENT = 32
FILTER_COLUMNS = [*S.PARTITION_COLUMNS, "segments", "segment", *WORDS]


def _hash(seed: int, key: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(seed), *key)


def _bits(key: Sequence[str]) -> list[Column]:
    """The bit a key sets in each of the eight words: six bits of one hash per word."""
    draw = F.col("__draw")
    place = [F.shiftrightunsigned(draw, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(len(WORDS))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in place]


def _placed(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with ``segments`` known: their segment and their draw."""
    return rows.withColumns({"segment": F.pmod(_hash(17, key), F.col("segments")).cast("int"), "__draw": _hash(23, key)})


def block_segments(keys: DataFrame, per_segment: int = KEYS_PER_SEGMENT, known: DataFrame | None = None) -> DataFrame:
    """(chrom, blk_pos, segments): enough segments for the keys of each block; blocks of ``known`` keep theirs."""
    part = list(S.PARTITION_COLUMNS)
    need = keys.groupBy(*part).agg(F.ceil(F.count(F.lit(1)) / per_segment).cast("int").alias("segments"))
    if known is None:
        return need
    held = known.groupBy(*part).agg(F.max("segments").alias("__held"))
    return need.join(held, part, "left").select(*part, F.coalesce("__held", "segments").alias("segments"))


def build_filter(
    keys: DataFrame, key: Sequence[str], per_segment: int = KEYS_PER_SEGMENT, known: DataFrame | None = None
) -> DataFrame:
    """Filter rows of distinct ``keys``; with ``known``, in the segments the stored filter already uses."""
    part = list(S.PARTITION_COLUMNS)
    sized = keys.join(block_segments(keys, per_segment, known), part)
    bits = {w: b for w, b in zip(WORDS, _bits(key), strict=True)}
    placed = _placed(sized, key).withColumns(bits)
    return placed.groupBy(*FILTER_COLUMNS[:4]).agg(*[F.bit_or(w).alias(w) for w in WORDS])


def merge_filters(rows: DataFrame) -> DataFrame:
    """One row per segment from the filter rows of several batches.

    Where a block has rows in more than one size, those of the largest count: a filter made anew with more segments replaces
    the one before it by being added.
    """
    part = list(S.PARTITION_COLUMNS)
    merged = rows.groupBy(*FILTER_COLUMNS[:4]).agg(*[F.bit_or(w).alias(w) for w in WORDS])
    sizes = rows.groupBy(*part).agg(F.max("segments").alias("segments"))
    return merged.join(sizes, [*part, "segments"], "left_semi")


def with_maybe(rows: DataFrame, merged: DataFrame, key: Sequence[str], strategy: str | None = "broadcast", flag: str = "maybe") -> DataFrame:
    """Rows with a flag: false where the key is surely not in the filter, true where it may be.

    ``merged`` is a filter after ``merge_filters``, best staged, as it is read four times. Both tables that the rows meet, one
    row per block and one per segment, are broadcast only where their measured size is under the broadcast bound; the rows
    then stay where they were read. Larger ones are joined by shuffle. A key with a null part is never looked up: it may
    be there.
    """
    part = list(S.PARTITION_COLUMNS)
    kept = rows.columns
    blocks = merged.select(*part, "segments").distinct()
    placed = _placed(rows.join(with_strategy(blocks, strategy), part, "left"), key)
    probed = placed.join(with_strategy(merged.drop("segments"), strategy), [*part, "segment"], "left")
    hit = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(b) != 0 for w, b in zip(WORDS, _bits(key), strict=True)])
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return probed.select(*kept, (unknown | F.coalesce(hit, F.lit(False))).alias(flag))


def filter_load(stored: DataFrame) -> DataFrame:
    """(chrom, blk_pos, load): share of the bits of each block that are set. Over a half, the filter should be rebuilt."""
    bits = reduce(lambda a, b: a + b, [F.bit_count(w) for w in WORDS])
    load = F.sum(bits) / (F.max("segments") * 64 * len(WORDS))
    return merge_filters(stored).groupBy(*S.PARTITION_COLUMNS).agg(load.alias("load"))
