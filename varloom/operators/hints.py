"""Join strategy hints with a size check on broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("broadcast", "shuffle_merge", "shuffle_hash")
MAX_BROADCAST_BYTES = 64_000_000


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of its texts, a fixed width for the rest."""
    width = F.lit(0)
    for f in df.schema.fields:
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        own = F.octet_length(F.col(f.name)) if text else F.octet_length(F.to_json(F.struct(f.name))) if nested else F.lit(8)
        width = width + F.coalesce(own, F.lit(0)) + 8
    return width.cast("long")


def table_bytes(df: DataFrame) -> int:
    """Size of a table by ``row_bytes``, from one aggregate with partial sums."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def with_strategy(df: DataFrame, strategy: str | None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked with a join strategy.

    ``None`` leaves the choice to Spark, which broadcasts only under its size threshold. A requested broadcast is
    honoured only after measuring that the side takes at most ``max_bytes``, texts included; a larger side keeps the
    shuffle join.
    """
    if strategy is None:
        return df
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "broadcast":
        return F.broadcast(df) if table_bytes(df) <= max_bytes else df
    return df.hint(strategy)
