"""Subject genotypes with adjusted allele counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from varloom.functions.columns import adjusted_mac, with_blk_pos
from varloom.operators.joins import strata_join


def strata_mac(calls: DataFrame, counts: DataFrame, seed: int = 7) -> DataFrame:
    """Position, subject and zygosity with the count, its exact share and the jittered share, by block."""
    rows = adjusted_mac(with_blk_pos(strata_join(calls, counts)), seed)
    return rows.select("pos", "subject_id", "zygosity", "mac", "mac_share", "adj_mac", "chrom", "blk_pos")
