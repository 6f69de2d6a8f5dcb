"""Interval joins.

Equality on chromosome alone leaves at most 25 shuffle keys. Here every interval is listed once per position bin it
touches and the join is an equality on (chrom, bin) with the bounds as a residual. A point lies in exactly one bin, so a
pair meets at most once and a left join stays a left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.operators.hints import MAX_BROADCAST_BYTES, row_bytes, table_bytes, with_strategy

_BIN, _BUILD_BIN, _LO, _HI, _CHROM = "__bin", "__build_bin", "__lo", "__hi", "__chrom"


def _bin(position: Column, width: int | Column) -> Column:
    return F.floor(position / width)


def _binned(df: DataFrame, lo: Column, hi: Column, width: int | Column, name: str) -> DataFrame:
    """One row per bin of [lo, hi]; intervals that hold no position are left out."""
    bins = F.sequence(_bin(F.col(_LO), width), _bin(F.col(_HI), width))
    return df.withColumns({_LO: lo, _HI: hi}).where(F.col(_LO) <= F.col(_HI)).withColumn(name, F.explode(bins))


MEASURED_BROADCAST = "measured_broadcast"


def range_strategy(
    intervals: DataFrame, *, start: str = "start", stop: str = "stop", shift: int = 0, pad: int = 0, width: int = S.RANGE_BIN_WIDTH
) -> str:
    """Whether intervals listed by bin are small enough to broadcast, in bytes, from one sum over the intervals.

    A plan with several joins against the same intervals asks once and hands the answer to each ``range_join``.
    """
    lo, hi = F.col(start) + (shift - pad), F.col(stop) + (shift + pad)
    listed = F.when(lo <= hi, (_bin(hi, width) - _bin(lo, width) + 1) * (row_bytes(intervals) + 32))
    size = intervals.agg(F.coalesce(F.sum(listed), F.lit(0))).first()[0]
    return MEASURED_BROADCAST if size <= MAX_BROADCAST_BYTES else "shuffle_merge"


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    how: str = "left",
    *,
    pos: str = "pos",
    start: str = "start",
    stop: str = "stop",
    chrom: str = "chrom",
    shift: int = 0,
    pad: int = 0,
    width: int = S.RANGE_BIN_WIDTH,
    block: str | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """Points with the intervals that hold them: same chromosome, start <= pos <= stop.

    ``shift`` moves both bounds, ``pad`` widens the interval on both sides. Columns both sides have are taken from
    the points. ``left_semi`` and ``left_anti`` keep or drop the points that lie in any interval.

    ``block`` names a column of the points that holds floor(pos / ``width``); where the points are stored by it, only the
    partitions that some interval touches are read.

    Spark's size estimate does not see that listing by bin multiplies the intervals. So without a ``strategy``
    ``range_strategy`` measures them first: little enough is broadcast, which leaves the points where they are, and more is
    joined by shuffle, where a hot bin is split at run time.
    """
    lo, hi = F.col(start) + (shift - pad), F.col(stop) + (shift + pad)
    kept = points.columns
    extra = [] if how in ("left_semi", "left_anti") else [c for c in intervals.columns if c not in kept]
    build = _binned(intervals, lo, hi, width, _BUILD_BIN).select(F.col(chrom).alias(_CHROM), _BUILD_BIN, _LO, _HI, *extra)
    if strategy is None:
        strategy = range_strategy(intervals, start=start, stop=stop, shift=shift, pad=pad, width=width)
    build = F.broadcast(build) if strategy == MEASURED_BROADCAST else with_strategy(build, strategy)
    if block is None:
        probe, at = points.withColumn(_BIN, _bin(F.col(pos), width)), F.col(_BIN)
    else:
        probe, at = points, F.col(block)
        build = build.withColumn(_BUILD_BIN, F.col(_BUILD_BIN).cast(points.schema[block].dataType))
    match = (F.col(chrom) == F.col(_CHROM)) & (at == F.col(_BUILD_BIN)) & F.col(pos).between(F.col(_LO), F.col(_HI))
    return probe.join(build, match, how).select(*kept, *extra)


def range_join_inner(points: DataFrame, intervals: DataFrame, **options) -> DataFrame:
    """Only the points that lie in an interval."""
    return range_join(points, intervals, "inner", **options)


# Bin widths by the length of a call: a call lies in one or two bins of its own width.
ALLELE_BINS = (1_000, 100_000, 10_000_000)


def interval_allele_join(
    calls: DataFrame,
    known: DataFrame,
    *,
    widths: tuple[int, ...] = ALLELE_BINS,
    strategy: str | None = None,
) -> DataFrame:
    """Two-allele interval calls with the known variants they carry.

    Same chromosome and reference allele, known position inside [start, stop], and the known alt equal to either
    allele. The alternatives stay in one residual, so a call with both alleles equal meets a variant once.

    A call is binned by the width of its length tier, so a call of a few bases meets only its neighbourhood and one of
    megabases few bins. A known variant is listed once per tier; tier, bin, chromosome and reference allele make the key.

    Spark's size estimate goes by the compressed files and does not see the listing by tier. So without a ``strategy`` the
    known variants are measured as they are listed: little enough is broadcast, more is joined by shuffle.
    """
    if strategy is None:
        strategy = MEASURED_BROADCAST if table_bytes(known) * len(widths) <= MAX_BROADCAST_BYTES else "shuffle_merge"
    kept = calls.columns
    extra = [c for c in known.columns if c not in kept]
    length = F.col("stop") - F.col("start")
    tier, width = F.lit(len(widths) - 1), F.lit(widths[-1])
    for i in range(len(widths) - 2, -1, -1):
        tier = F.when(length < widths[i], F.lit(i)).otherwise(tier)
        width = F.when(length < widths[i], F.lit(widths[i])).otherwise(width)
    probe = _binned(calls.withColumn("__tier", tier), F.col("start"), F.col("stop"), width, _BIN)
    tiers = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), _bin(F.col("pos"), w).alias("b")) for i, w in enumerate(widths)]))
    build = known.withColumn("__at", tiers).withColumnRenamed("ref", "__ref")
    build = build.select(F.col("__at.t").alias("__known_tier"), F.col("__at.b").alias(_BUILD_BIN), "__ref", *extra)
    build = F.broadcast(build) if strategy == MEASURED_BROADCAST else with_strategy(build, strategy)
    match = (
        (F.col("chr") == F.col("chrom"))
        & (F.col("ref") == F.col("__ref"))
        & (F.col("__tier") == F.col("__known_tier"))
        & (F.col(_BIN) == F.col(_BUILD_BIN))
        & F.col("pos").between(F.col("start"), F.col("stop"))
        & ((F.col("alt") == F.col("allele1seq")) | (F.col("alt") == F.col("allele2seq")))
    )
    return probe.join(build, match).select(*kept, *extra)
