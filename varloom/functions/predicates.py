"""Row filters and boolean labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import pathogenic

__all__ = [
    "build_predicate", "filter_autosomes", "filter_find_in_set", "filter_high_risk", "filter_quality", "filter_trio",
    "in_code_set", "label_predictive",
]


def filter_quality(df: DataFrame, qual: float = 30, dp: float = 10, passed: bool = False) -> DataFrame:
    """Called genotypes with enough quality and depth; ``passed`` also asks for filter PASS."""
    keep = (F.col("qual") >= qual) & (F.col("dp") >= dp) & F.col("gt").isNotNull()
    return df.where(keep & (F.col("filter") == "PASS") if passed else keep)


def filter_autosomes(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Without the sex chromosomes."""
    return df.where(~F.col(chrom).isin(*S.SEX_CHROMOSOMES))


def filter_trio(
    df: DataFrame,
    members: Iterable[str] | str = "all",
    samples: Iterable[str] | str = "all",
    suffixes: Mapping[str, str] = S.MEMBER_SUFFIXES,
    sample: str = "sample_id",
) -> DataFrame:
    """Keeps the named trio members (by id suffix) and sample ids; ``all`` or an empty list sets no filter."""
    if members and members != "all":
        df = df.where(reduce(or_, [F.col(sample).endswith(suffixes[m]) for m in members]))
    if samples and samples != "all":
        df = df.where(F.col(sample).isin(*samples))
    return df


def build_predicate(args: Mapping[str, str]) -> Column:
    """AND of user filters: ``all`` is skipped, a comma list is IN, a single value is equality."""
    chosen = {name: value.split(",") for name, value in args.items() if value != "all"}
    return reduce(and_, [F.col(name).isin(*values) for name, values in chosen.items()], F.lit(True))


def in_code_set(code: str, codes: str | Column, sep: str = ",") -> Column:
    """Whether ``code`` is an element of a separated code list."""
    codes = F.col(codes) if isinstance(codes, str) else codes
    return F.find_in_set(F.lit(code), codes if sep == "," else F.translate(codes, sep, ",")) > 0


def filter_find_in_set(df: DataFrame, sig: str = "clin_sig", sep: str = ",", strict: bool = True) -> DataFrame:
    """Code list holds 4 or 5 and neither 2 nor 3. ``strict=False``: code 4 passes whatever else is listed."""
    has = {code: in_code_set(code, sig, sep) for code in "2345"}
    clean = ~has["2"] & ~has["3"]
    return df.where((has["4"] | has["5"]) & clean if strict else has["4"] | (has["5"] & clean))


def filter_high_risk(df: DataFrame, freq: str = "kav_freq", threshold: float = 0.01, sig: str = "clin_sig") -> DataFrame:
    """Rare with a high-impact effect, or pathogenic."""
    rare = (F.col(freq) < threshold) | F.col(freq).isNull()
    return df.where((rare & (F.col("impact") == "HIGH")) | pathogenic(F.col(sig)))


def label_predictive(df: DataFrame, dann: float = 0.96) -> DataFrame:
    """True when pathogenic in ClinVar, or rare and (high impact, predicted damaging, or DANN at the cutoff)."""
    harmful = (
        (F.col("impact") == "HIGH") | (F.col("predicted_damaging") == "Y") | (F.col("dann_score") >= dann)
    )
    label = (F.col("clin_patho") == "Y") | ((F.col("kaviar_rare") == "Y") & harmful)
    return df.withColumn("predictive", F.coalesce(label, F.lit(False)))
