"""Groups of any size compared in bounded blocks, and connected components of the links found.

A group of n members is dealt into chunks by a hash of the member; every pair of chunks is one block. A member is sent
once to each block it takes part in, so that a block has a bounded number of rows and large groups spread over tasks.
No row per pair is ever made: a block returns links that connect what belongs together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.session import stage


def chunked(members: DataFrame, group: str, chunks: str, member: str = "member") -> DataFrame:
    """Adds ``own`` (the member's chunk), ``lo`` and ``hi`` (the block): one row per block of the member.

    ``chunks`` is the group's number of chunks. Block (i, i) holds chunk i, block (i, j) the chunks i < j.
    """
    own = F.pmod(F.xxhash64(F.lit(11), member), F.col(chunks)).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks).cast("int") - 1)))
    return dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", chunks)


def local_links(near: np.ndarray) -> list[tuple[int, int]]:
    """(row, representative) for a symmetric matrix of links: every row with the first row it is connected to."""
    n = len(near)
    label = np.arange(n)
    near = near | np.eye(n, dtype=bool)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(i, int(k)) for i, k in enumerate(label) if i != k]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut at group borders, with where each group begins and the end; rows come sorted by the first ``keys`` columns.

    A group that goes on in the next batch is held back, so a caller sees many whole groups at a time.
    """
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        new = np.ones(batch.num_rows, bool)
        new[1:] = False
        for k in range(keys):
            values = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        begin = np.flatnonzero(new)
        if len(begin) > 1:
            yield batch.slice(0, int(begin[-1])), begin
        held = batch.slice(int(begin[-1]))
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def stacked_labels(near: np.ndarray) -> np.ndarray:
    """For each of a stack of symmetric matrices of links: every row's first connected row."""
    n = near.shape[1]
    label = np.broadcast_to(np.arange(n), near.shape[:2])
    near = near | np.eye(n, dtype=bool)
    while True:
        new = np.where(near, label[:, None, :], n).min(axis=2)
        new = np.take_along_axis(new, new, axis=1)
        if (new == label).all():
            return new
        label = new


def shared_counts(values: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, exactly, by products of bounded slabs of the incidence matrix."""
    n = len(values)
    sizes = np.array([len(v) for v in values])
    flat = np.concatenate(values) if n else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    count = np.bincount(column) if len(column) else np.zeros(0, np.int64)
    common = count[column] > 1
    rows, column = rows[common], column[common]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((n, n))
    width = max(256, (1 << 22) // max(n, 1))
    for begin in range(0, int(column.max(initial=-1)) + 1, width):
        part = slice(np.searchsorted(column, begin), np.searchsorted(column, begin + width))
        slab = np.zeros((n, width), np.float32)
        slab[rows[part], column[part] - begin] = 1
        out += slab @ slab.T
    np.fill_diagonal(out, sizes)
    return out


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(member, component_id) for every end of ``links`` (a, b); the component is named by its smallest member.

    Each round takes the smallest label among the neighbours (a sum by key with partial sums) and then the label of that
    label. Labels are staged after each round, which cuts the lineage; only a count of changes reaches the driver.
    """
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = stage(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-links")
    labels = stage(both.groupBy(F.col("a").alias("member")).agg(F.least("a", F.min("b")).alias("component_id")), label)
    while True:
        heard = both.join(labels.withColumnRenamed("member", "b"), "b").select(F.col("a").alias("member"), "component_id")
        best = labels.union(heard).groupBy("member").agg(F.min("component_id").alias("component_id"))
        best = stage(best, label)
        jump = best.select(F.col("member").alias("component_id"), F.col("component_id").alias("further"))
        new = best.join(jump, "component_id", "left").select("member", F.coalesce("further", "component_id").alias("component_id"))
        new = stage(new, label)
        before = labels.withColumnRenamed("component_id", "was")
        if new.join(before, "member").where("component_id <> was").isEmpty():
            return new
        labels = new
