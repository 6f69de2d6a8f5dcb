"""Allele statistics: frequency, missingness, marker order, linkage and thinning."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.session import stage

SITE = ["chrom", "pos", "ref"]
SAMPLE_BLOCK = 63  # samples whose calls at a marker share one row
SAMPLE_BUCKETS = 1024


def cohort_size(cohort: DataFrame | int) -> int:
    """Samples of a cohort: a number, or a table whose first column names them (repeats count once)."""
    return cohort if isinstance(cohort, int) else cohort.select(cohort.columns[0]).na.drop().distinct().count()


def allele_frequency(flags: DataFrame, cohort: DataFrame | int, site: Sequence[str] = SITE) -> DataFrame:
    """Alternate-allele frequency of two-allele calls per site, over the whole cohort.

    ``flags`` has one row per stored call with ``allele1_alt_count`` and ``allele2_alt_count``. Call tables hold variants,
    so a sample of the cohort without a row has two reference alleles; one whose counts are null is missing and leaves
    the denominator. The frequency is alternate alleles / (2 x ``n_samples``), ``maf`` the smaller of it and its
    complement. Rows of one sample at a site count one by one.
    """
    alts = F.col("allele1_alt_count") + F.col("allele2_alt_count")
    return _counted(flags.withColumn("__alts", alts).groupBy(*site), "__alts", F.lit(cohort_size(cohort)))


def _counted(groups, alts: str, cohort: Column) -> DataFrame:
    missing = F.count_if(F.col(alts).isNull())
    counted = groups.agg(
        F.coalesce(F.sum(alts), F.lit(0)).cast("long").alias("alt_alleles"), (cohort - missing).cast("long").alias("n_samples")
    )
    return _with_frequency(counted)


def _with_frequency(counted: DataFrame) -> DataFrame:
    frequency = F.try_divide(F.col("alt_alleles"), 2 * F.col("n_samples"))
    return counted.withColumn("alt_freq", frequency).withColumn("maf", F.least("alt_freq", 1 - F.col("alt_freq")))


def sample_dosages(
    calls: DataFrame, marker: Sequence[str] = S.VARIANT_KEY, sample: str = "subject_id", missing: bool = False
) -> DataFrame:
    """One dosage per sample and marker; repeated calls keep the larger.

    With ``missing`` a sample whose calls all lack a genotype keeps a row with a null dosage, which frequencies need.
    It shuffles all calls. Calls known to be unique need only their ``dosage`` column and can skip it.
    """
    known = calls if missing else calls.where(F.col("dosage").isNotNull())
    return known.groupBy(sample, *marker).agg(F.max("dosage").alias("dosage"))


def dosage_frequency(dosages: DataFrame, cohort: DataFrame | int, marker: Sequence[str] = S.VARIANT_KEY) -> DataFrame:
    """Allele frequency per marker over the cohort: no row is two reference alleles, a null dosage is missing."""
    return _counted(dosages.groupBy(*marker), "dosage", F.lit(cohort_size(cohort)))


def filter_maf(frequencies: DataFrame, low: float = 0.05, high: float = 0.49) -> DataFrame:
    """Sites with minor-allele frequency in [low, high]."""
    return frequencies.where(F.col("maf").between(low, high))


def missing_rate(calls: DataFrame, site: Sequence[str] = S.VARIANT_KEY) -> DataFrame:
    """Share of the stored calls without a genotype per site; samples without a row are not part of it."""
    return calls.groupBy(*site).agg(F.avg(F.col("gt").isNull().cast("int")).alias("missing_rate"))


def filter_missing(calls: DataFrame, max_missing: float = 0.999, site: Sequence[str] = S.VARIANT_KEY) -> DataFrame:
    """Sites whose missing-call share is at most ``max_missing``."""
    return missing_rate(calls, site).where(F.col("missing_rate") <= max_missing)


def biallelic_only(
    df: DataFrame, min_alt: int = 0, max_missing: float | None = None, site: Sequence[str] = ("chrom", "pos")
) -> DataFrame:
    """Rows of sites with one alternate allele (none multi-valued) and, if asked, enough alternate alleles or calls.

    A site fails when any row lists several alleles or two rows disagree on ref or alt. The share of missing calls
    is taken in the same aggregate.
    """
    single = (F.min("ref") == F.max("ref")) & (F.min("alt") == F.max("alt")) & ~F.max(F.col("alt").contains(","))
    keep = single & (F.coalesce(F.sum("dosage"), F.lit(0)) >= min_alt)
    if max_missing is not None:
        keep = keep & (F.avg(F.col("dosage").isNull().cast("int")) <= max_missing)
    kept = df.groupBy(*site).agg(keep.alias("keep")).where("keep").select(*site)
    return df.join(kept, list(site), "left_semi")


def population_frequency(
    dosages: DataFrame, panel: DataFrame, level: str = "pop", marker: Sequence[str] = S.VARIANT_KEY
) -> DataFrame:
    """Allele frequency per marker and population, over all of the population's panel samples.

    A marker no sample of a population has a row for is not listed for it.
    """
    known = panel.select(F.col("sample").alias("subject_id"), level).distinct()
    sizes = known.groupBy(level).agg(F.count(F.lit(1)).alias("__size"))
    sized = known.join(sizes, level)
    return _counted(dosages.join(sized, "subject_id").groupBy(*marker, level), "dosage", F.max("__size"))


def marker_index(df: DataFrame, key: Sequence[str] = S.VARIANT_KEY, width: int = S.BLOCK_WIDTH) -> DataFrame:
    """Distinct markers with their 0-based position order in the chromosome.

    Numbers are given inside each position block and shifted by the marker counts of the blocks before it, so no task
    sorts a whole chromosome; a block holds at most ``width`` positions.
    """
    order = [c for c in key if c != "chrom"]
    markers = df.select(*key).distinct().withColumn("__blk", F.floor(F.col("pos") / width))
    before = Window.partitionBy("chrom").orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        markers.groupBy("chrom", "__blk")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    )
    inside = Window.partitionBy("chrom", "__blk").orderBy(*order)
    return (
        markers.withColumn("__rn", F.row_number().over(inside))
        .join(offsets.drop("__n"), ["chrom", "__blk"])
        .select(*key, (F.col("__offset") + F.col("__rn") - 1).alias("idx"))
    )


def ld_pairs(
    dosages: DataFrame,
    window: int = 50,
    step: int = 5,
    marker: Sequence[str] = S.VARIANT_KEY,
    sample: str = "subject_id",
    index: DataFrame | None = None,
) -> DataFrame:
    """Squared dosage correlation of the marker pairs that share a sliding window.

    Marker i meets marker j > i when j < floor(i / step) * step + window, with 0-based order in the chromosome. Only samples
    with a called row at both markers count: a sample without a row is left out here, not taken for two reference
    alleles. Dosages are 0, 1 or 2, one row per sample and marker. ``index`` is the marker order when it is already known.

    Samples are dealt into blocks of 63, and a marker has one row per block: three bit sets, who is called, who has one
    alternate allele, who has two. Inside a block each marker meets the markers in its window, and the sums of a pair in a
    block are bit counts, so rows per sample and pair never arise; a marker meets at most ``window`` rows. Dosages are shuffled
    by bucket of samples once: numbers, blocks and windows all stay inside a chromosome's bucket.
    """
    if index is None:
        dosages = stage(dosages.select(sample, *marker, "dosage"), "dosages")
        index = marker_index(dosages, marker)
    called = dosages.where(F.col("dosage").between(0, 2) & F.col(sample).isNotNull())
    bucket = F.pmod(F.xxhash64(sample), F.lit(SAMPLE_BUCKETS)).alias("bucket")
    placed = called.join(index, list(marker)).select("chrom", bucket, F.col(sample).alias("sample"), F.col("idx").cast("long"), "dosage")
    number = F.dense_rank().over(Window.partitionBy("chrom", "bucket").orderBy("sample")) - 1
    bit = F.expr(f"shiftleft(1L, cast(pmod(no, {SAMPLE_BLOCK}) as int))")
    placed = placed.withColumn("no", number).withColumns({"block": F.floor(F.col("no") / SAMPLE_BLOCK), "bit": bit})
    bits = lambda k: F.coalesce(F.bit_or(F.when(F.col("dosage") == k, F.col("bit"))), F.lit(0).cast("long"))
    group = ("chrom", "bucket", "block")
    blocks = placed.groupBy(*group, "idx").agg(F.bit_or("bit").alias("p"), bits(1).alias("one"), bits(2).alias("two"))
    near = Window.partitionBy(*group).orderBy("idx").rangeBetween(1, max(window - 1, 1))
    sets = ("p", "one", "two")
    second = F.struct(F.col("idx").alias("idx_j"), *[F.col(c).alias(f"y_{c}") for c in sets])
    met = blocks.withColumn("near", F.collect_list(second).over(near))
    pairs = met.select("chrom", F.col("idx").alias("idx_i"), *[F.col(c).alias(f"x_{c}") for c in sets], F.inline("near"))
    pairs = pairs.where(F.col("idx_j") < F.floor(F.col("idx_i") / step) * step + window)

    def both(a: str, b: str) -> Column:
        return F.bit_count(F.col(f"x_{a}").bitwiseAND(F.col(f"y_{b}")))

    values = {
        "n": both("p", "p"),
        "sx": both("one", "p") + 2 * both("two", "p"),
        "sy": both("p", "one") + 2 * both("p", "two"),
        "sxx": both("one", "p") + 4 * both("two", "p"),
        "syy": both("p", "one") + 4 * both("p", "two"),
        "sxy": both("one", "one") + 2 * (both("one", "two") + both("two", "one")) + 4 * both("two", "two"),
    }
    sums = pairs.groupBy("chrom", "idx_i", "idx_j").agg(
        F.sum(values["n"]).alias("n"), *[F.sum(e).cast("double").alias(c) for c, e in values.items() if c != "n"]
    )
    sums = sums.where("n > 0")
    # Dosages are small integers, so these sums are exact in any order and so is the test for zero variance.
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    cov, vx, vy = n * F.col("sxy") - sx * sy, n * F.col("sxx") - sx * sx, n * F.col("syy") - sy * sy
    r2 = F.when((vx > 0) & (vy > 0), cov * cov / (vx * vy))
    return sums.select("chrom", "idx_i", "idx_j", "n", r2.alias("r2"))


def ld_prune(
    dosages: DataFrame,
    window: int = 50,
    step: int = 5,
    cutoff: float = 0.5,
    marker: Sequence[str] = S.VARIANT_KEY,
    sample: str = "subject_id",
) -> DataFrame:
    """Markers left after dropping the first of every window pair with r-squared over the cutoff.

    The dosages and the marker order are read more than once here, so they are staged.
    """
    dosages = stage(dosages.select(sample, *marker, "dosage"), "dosages")
    index = stage(marker_index(dosages, marker), "index")
    pairs = ld_pairs(dosages, window, step, marker, sample, index)
    dropped = pairs.where(F.col("r2") > cutoff).select("chrom", F.col("idx_i").alias("idx")).distinct()
    return index.join(dropped, ["chrom", "idx"], "left_anti").select(*marker, "idx")


# --- thinning -------------------------------------------------------------------------------------------------------


def thin_markers(df: DataFrame, bp: int = 2000, width: int = S.BLOCK_WIDTH) -> DataFrame:
    """Positions kept by walking each chromosome left to right and skipping any closer than ``bp`` to the last kept.

    The walk is sequential, but what it does inside a block depends only on the first position it keeps there, and
    that is one of the block's first ``bp`` positions (or the one after them). So: (1) every block tabulates, for each
    possible first position, the last one kept; walks soon meet, so the last position is a step function of the first,
    and only its steps are kept; (2) the steps of a chromosome are chained to find where the walk enters each block; (3)
    every block walks once from its entry. No task sees more than a block's positions or a chromosome's steps.
    """
    width = max(width, bp)
    sites = df.select("chrom", "pos").dropna().distinct().withColumn("blk", F.floor(F.col("pos") / width))
    kind = sites.schema["pos"].dataType.simpleString()

    # The functions below refer only to each other, numpy and pandas, so executors need no copy of this package.
    def next_kept(pos: np.ndarray) -> np.ndarray:
        """For each position the index of the next one kept after it; the length of ``pos`` when there is none."""
        return np.searchsorted(pos, pos + bp, side="left")

    def tabulate(block: pd.DataFrame) -> pd.DataFrame:
        pos = np.sort(block["pos"].to_numpy())
        n = len(pos)
        last = np.append(next_kept(pos), n)
        last[last == n] = np.arange(n + 1)[last == n]
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        start = int(block["blk"].iloc[0]) * width
        entries = min(n, int(np.searchsorted(pos, start + bp, side="left")) + 1)
        first, kept = pos[:entries], pos[last[:entries]]
        upper = np.append(kept[1:] != kept[:-1], True)[:entries]
        chrom, blk = block["chrom"].iloc[0], block["blk"].iloc[0]
        return pd.DataFrame({"chrom": chrom, "blk": blk, "first_pos": first[upper], "last_pos": kept[upper]})

    def chain(tables: pd.DataFrame) -> pd.DataFrame:
        entry, rows = None, []
        for blk, table in tables.sort_values(["blk", "first_pos"]).groupby("blk", sort=True):
            first = table["first_pos"].to_numpy()
            at = 0 if entry is None else int(np.searchsorted(first, entry, side="left"))
            if at < len(first):
                rows.append((tables["chrom"].iloc[0], blk, blk * width if entry is None else entry))
                entry = table["last_pos"].iloc[at] + bp
        return pd.DataFrame(rows, columns=["chrom", "blk", "entry"])

    def walk(block: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        kept = []
        if len(block) and len(entries):
            pos = np.sort(block["pos"].to_numpy())
            following = next_kept(pos)
            at = int(np.searchsorted(pos, entries["entry"].iloc[0], side="left"))
            while at < len(pos):
                kept.append(at)
                at = int(following[at])
            return pd.DataFrame({"chrom": block["chrom"].iloc[0], "pos": pos[kept]})
        return pd.DataFrame({"chrom": pd.Series(dtype=str), "pos": pd.Series(dtype="int64")})

    blocks = sites.groupBy("chrom", "blk")
    tables = blocks.applyInPandas(tabulate, f"chrom string, blk long, first_pos {kind}, last_pos {kind}")
    entries = tables.groupBy("chrom").applyInPandas(chain, f"chrom string, blk long, entry {kind}")
    return blocks.cogroup(entries.groupBy("chrom", "blk")).applyInPandas(walk, f"chrom string, pos {kind}")
