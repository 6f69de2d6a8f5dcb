"""Linkage pruning as the called tool does it: of two linked markers in a sliding window, the rarer one goes.

Windows of ``window`` markers start every ``step`` markers. In a window, passes over the live markers in order are
made until one changes nothing; in a pass each marker takes the first live marker after it that it is linked with, and of
the two the one with the smaller minor-allele frequency goes, on equal frequencies the second.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.statistics import ld_pairs, marker_index
from varloom.session import stage

BLOCK_WINDOWS = 1000  # windows worked through together
EQUAL = 1e-9  # frequencies closer than this share of them are equal

_RESULT = "chrom string, block long, given array<long>, gone array<long>, passed array<long>"


def linked_pairs(pairs: DataFrame, frequencies: DataFrame, cutoff: float) -> DataFrame:
    """(chrom, i, j, first_goes) of the pairs over the cutoff; ``frequencies`` has (chrom, idx, maf)."""
    maf = lambda k: frequencies.select("chrom", F.col("idx").alias(f"idx_{k}"), F.col("maf").alias(f"maf_{k}"))
    linked = pairs.where(F.col("r2") > cutoff).join(maf("i"), ["chrom", "idx_i"]).join(maf("j"), ["chrom", "idx_j"])
    return linked.select("chrom", F.col("idx_i").alias("i"), F.col("idx_j").alias("j"), (F.col("maf_i") < F.col("maf_j") * (1 - EQUAL)).alias("first_goes"))


def pruned_markers(edges: DataFrame, window: int, step: int, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(chrom, idx) of the markers that go, from the linked pairs of ``linked_pairs``.

    A window depends on the one before it only through the markers they share. So a block of windows needs no more than its own
    pairs and which of its first ``window - step`` markers have gone, and all blocks are worked out at once from what was last
    known of that: from nothing at first, then again wherever the block before has passed on something else, until
    nothing changes. The first block is right at once and each block is right one round after the one before it, so the end
    is the sequential result; since effects die out within a few windows, few rounds do. What blocks pass on is a staged table, a
    task holds the pairs of one block and only counts reach the driver.
    """
    width = max(block_windows, -(-window // step)) * step  # markers at which the windows of a block start

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        chrom, block = rows["chrom"].iloc[0], int(rows["block"].iloc[0])
        given = [int(x) for x in rows["given"].iloc[0]]
        gone = set(given)
        partners: dict[int, list[tuple[int, bool]]] = {}
        for i, j, first in sorted(zip(rows["i"], rows["j"], rows["first_goes"])):
            partners.setdefault(int(i), []).append((int(j), bool(first)))
        order = sorted(partners)
        begin = block * width
        for start in range(begin, begin + width, step):
            inside = [i for i in order if start <= i < start + window]
            changed = True
            while changed:
                changed = False
                for i in inside:
                    if i in gone:
                        continue
                    for j, first in partners[i]:
                        if j < start + window and j not in gone:
                            gone.add(i if first else j)
                            changed = True
                            break
        passed = sorted(x for x in gone if begin + width <= x < begin + width + window - step)
        values = {"chrom": chrom, "block": block, "given": given, "gone": sorted(gone - set(given)), "passed": passed}
        return pd.DataFrame({k: [v] for k, v in values.items()})

    # Starts of the windows that hold both ends: the multiples of ``step`` over j - window, up to i.
    first = F.greatest(F.lit(0), F.ceil((F.col("j") - window + 1) / step) * step)
    last = F.floor(F.col("i") / step) * step
    placed = edges.withColumn("block", F.explode(F.sequence(F.floor(first / width), F.floor(last / width))))
    placed = stage(placed.where(first <= last), "linked")
    nothing = F.array().cast("array<long>")
    results = None
    todo = placed.select("chrom", "block").distinct().withColumn("given", nothing)
    while True:
        found = placed.join(todo, ["chrom", "block"]).groupBy("chrom", "block").applyInPandas(walk, _RESULT)
        found = stage(found, "pruned")
        if results is not None:
            found = stage(results.join(found, ["chrom", "block"], "left_anti").unionByName(found), "pruned")
        results = found
        passed = results.select("chrom", (F.col("block") + 1).alias("block"), F.col("passed").alias("now"))
        held = results.select("chrom", "block", "given").join(passed, ["chrom", "block"], "left")
        held = held.select("chrom", "block", "given", F.coalesce("now", nothing).alias("now"))
        todo = held.where(F.col("now") != F.col("given")).select("chrom", "block", F.col("now").alias("given"))
        if todo.isEmpty():
            return results.select("chrom", F.explode("gone").alias("idx")).distinct()


def prune_by_frequency(
    dosages: DataFrame,
    frequencies: DataFrame,
    window: int = 50,
    step: int = 5,
    cutoff: float = 0.5,
    marker: Sequence[str] = S.VARIANT_KEY,
    sample: str = "subject_id",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Markers left after pruning, with their order ``idx``. ``frequencies`` has the marker columns and ``maf``.

    Linkage is that of ``ld_pairs``. A marker without a frequency is linked with nothing. Dosages, marker order and
    frequencies are read more than once, so they are staged.
    """
    dosages = stage(dosages.select(sample, *marker, "dosage"), "dosages")
    index = stage(marker_index(dosages, marker), "index")
    numbered = stage(index.join(frequencies.select(*marker, "maf"), list(marker)).select("chrom", "idx", "maf"), "frequencies")
    edges = linked_pairs(ld_pairs(dosages, window, step, marker, sample, index), numbered, cutoff)
    gone = pruned_markers(edges, window, step, block_windows)
    return index.join(gone, ["chrom", "idx"], "left_anti").select(*marker, "idx")
