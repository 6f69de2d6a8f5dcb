"""Reports over stored tables, planned by their statistics."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom import schema as S
from varloom.functions.columns import normalize_gt
from varloom.functions.predicates import filter_high_risk, filter_quality
from varloom.operators.ranges import range_join_inner
from varloom.sources.catalog import compute_stats

COST_BASED = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the time of a block; what the session had before comes back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def analyze(spark: SparkSession, *tables: str) -> None:
    """Row counts, distinct counts, bounds and equal-height histograms of all columns of stored tables."""
    with session_settings(spark, COST_BASED):
        for table in tables:
            compute_stats(spark, table)


def locate_variants(variants: DataFrame, regions: DataFrame, *, shift: int = 0, pad: int = 0, start: str = "txstart", stop: str = "txstop") -> DataFrame:
    """Variant keys with the regions that hold them and the moved bounds: the table a stored report joins by key."""
    located = range_join_inner(variants.select(*S.VARIANT_KEY), regions, start=start, stop=stop, shift=shift, pad=pad)
    bounds = {"region_start": F.col(start) + (shift - pad), "region_stop": F.col(stop) + (shift + pad)}
    return located.withColumns(bounds).drop(start, stop)


def high_risk_stored(
    spark: SparkSession, calls: str, located: str, variants: str, coding: str, *, qual: float = 30, dp: float = 10, kav_freq: float = 0.01
) -> DataFrame:
    """Well-called variants in regions that are rare with high impact, or pathogenic, from four tables of the catalog.

    ``located`` holds what ``locate_variants`` gives. The joins are one flat chain on the variant key in the order the question is
    asked: calls, their region, what is known of the variant, its consequence. After ``analyze`` and under ``COST_BASED`` the
    optimizer orders them by the rows it expects each join to leave, with the share of calls that pass the quality filter taken
    from histograms. The rows are the same either way.
    """
    key = list(S.VARIANT_KEY)
    chain = filter_quality(spark.table(calls), qual, dp)
    for table in (located, variants, coding):
        chain = chain.join(spark.table(table), key)
    return normalize_gt(filter_high_risk(chain, threshold=kav_freq))
