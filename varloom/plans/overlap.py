"""Overlap counts of two distinct-variant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators.aggregates import count_rows
from varloom.sources.catalog import variant_union_view, variant_view

SHAPES = ("tables", "views", "outer_filter", "inner_filter")


def variant_overlap_count(left: DataFrame, right: DataFrame, shape: str = "tables", chrom: str = "1") -> DataFrame:
    """Number of merged distinct variants on a chromosome.

    ``tables`` and ``views`` filter both sides of the merge, which keeps the shared variants; ``inner_filter`` does
    the same inside a view; ``outer_filter`` filters a view of the whole merge and so counts variants of either side.
    """
    if shape == "views":
        left, right = variant_view(left, "left_variants"), variant_view(right, "right_variants")
    if shape == "outer_filter":
        merged = variant_union_view(left, right, "merged_variants").where(F.col("chrom") == chrom)
    else:
        merged = variant_union_view(left, right, f"shared_variants_{shape}", both=True, chrom=chrom)
    return count_rows(merged)
