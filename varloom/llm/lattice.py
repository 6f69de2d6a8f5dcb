"""Near-duplicate vectors by E8 lattice hashing: projected vectors share or neighbour a lattice cell, cosine decides."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.blocks import chunked, components, local_links, stacked_labels, whole_groups
from varloom.llm.words import U64, binary_rows, list_column, mix, seeded, signed
from varloom.session import stage

TABLES = 8
POINTS = 2  # lattice points that make up a cell
SCALE = 2.0
PROBES = 3  # neighbouring cells tried for each lattice point
BLOCK_MEMBERS = 512
PAIRS = 1 << 18  # pairs of vectors compared together


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or eight halves with an even number of minus signs."""
    whole = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    halves = [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(whole + halves)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd round the worst entry the other way."""
    near = np.rint(x)
    gap = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(gap[odd]).argmax(axis=1)
    near[odd, worst] += np.where(gap[odd, worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: the better of the nearest whole and the nearest half-shifted point."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cells(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Hashes of the home cell and the probed cells of each unit vector in every table: (rows, tables * cells)."""
    n, width = unit.shape
    short = roots()
    out = []
    for t in range(tables):
        draw = np.random.default_rng(1000 * width + t).normal(size=(width, 8 * POINTS)) / np.sqrt(8)
        points, others = [], []
        for p in range(POINTS):
            x = SCALE * (unit @ draw[:, 8 * p : 8 * p + 8])
            home = nearest_e8(x)
            gain = (x - home) @ short.T
            best = np.argsort(-gain, axis=1, kind="stable")[:, :PROBES]
            points.append(home)
            others.append([home + short[best[:, k]] for k in range(PROBES)])
        tried = [points]
        for p in range(POINTS):
            tried += [points[:p] + [q] + points[p + 1 :] for q in others[p]]
        for cell in tried:
            whole = np.rint(2 * np.concatenate(cell, axis=1)).astype(np.int64).view(U64)
            key = np.full(n, mix(np.array([1000 * width + t], U64))[0])
            for k in range(whole.shape[1]):
                key = mix(key * U64(0xD6E8FEB86659FD93) + whole[:, k])
            out.append(key)
    return np.stack(out, axis=1) if out else np.zeros((n, 0), U64)


def _keyed(vectors: DataFrame, tables: int) -> DataFrame:
    """vec_id, digests of the vector, its bytes as doubles, cells; vectors that link with nothing have null digests."""

    def run(batches):
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1).to_pylist()
            good = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
            by_width: dict[int, list[int]] = {}
            for i in good:
                by_width.setdefault(len(rows[i]), []).append(i)
            bad = sorted(set(range(len(rows))) - set(good))
            if bad:
                nothing = pa.nulls(len(bad), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(bad)), nothing, nothing, pa.nulls(len(bad), pa.binary()), pa.nulls(len(bad), pa.list_(pa.int64()))], names=names
                )
            for places in by_width.values():
                x = np.array([rows[i] for i in places], np.float64) + 0.0
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                bits, d1, d2 = x.view(U64), np.zeros(len(x), U64), np.ones(len(x), U64)
                for k in range(bits.shape[1]):
                    d1, d2 = mix(d1 * U64(0xD6E8FEB86659FD93) + bits[:, k]), seeded(d2 + bits[:, k], k + 3)
                key = signed(cells(unit, tables))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(places)), pa.array(signed(d1)), pa.array(signed(d2)), binary_rows(unit), list_column(key.ravel(), np.arange(len(x) + 1) * key.shape[1], pa.int64())],
                    names=names,
                )

    names = ["vec_id", "d1", "d2", "unit", "cells"]
    picked = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return picked.mapInArrow(run, "vec_id long, d1 long, d2 long, unit binary, cells array<long>")


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["unit"]), np.float64).reshape(len(pdf), -1)


def near_vectors(vectors: DataFrame, cosine: float = 0.95, tables: int = TABLES) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are brought down to one with its number of copies. In each table a vector lies in the cell of its
    nearest lattice points and tries neighbouring cells; vectors that meet in a cell and reach ``cosine`` form groups.
    Inside a group all pairs are compared in bounded blocks, in double precision; a block returns sums and links that
    connect, never a row per pair. ``n_links`` counts the other vectors linked directly, copies included.

    Null and zero vectors and those with null or non-finite entries link with nothing and are kept. Vectors of different
    length do not link. Rows with the same vec_id count as one; a null vec_id comes back once, without links. Labels and
    other columns are ignored; empty input gives no rows.
    """
    rows = stage(_keyed(vectors, tables), "vec-cells")
    small = rows.groupBy("vec_id").agg(F.min(F.struct("d1", "d2")).alias("d")).select("vec_id", "d.*")
    filled = small.where("d1 is not null and vec_id is not null")
    same = stage(filled.groupBy("d1", "d2").agg(F.min("vec_id").alias("member"), F.count("*").alias("copies")), "vec-classes")
    reps = rows.join(same.select(F.col("member").alias("vec_id"), "d1", "d2"), ["vec_id", "d1", "d2"], "left_semi")
    reps = stage(reps.dropDuplicates(["vec_id"]).select("vec_id", "unit", "cells"), "vec-distinct")

    keyed = reps.select("vec_id", F.explode(F.array_distinct("cells")).alias("cell"))
    full = keyed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(full.select("cell", F.ceil(F.col("n") / BLOCK_MEMBERS).alias("chunks")), "cell")
    blocks = chunked(members.withColumnRenamed("vec_id", "member"), "cell", "chunks")
    dealt = blocks.join(reps.select(F.col("vec_id").alias("member"), "unit"), "member").select("cell", "lo", "hi", "member", "unit")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin in whole_groups(batches, 3):
            ids, units, sizes = batch.column(3).to_numpy(), batch.column(4), np.diff(begin)
            width = pc.binary_length(units).to_numpy()[begin[:-1]] // 8
            for n, w in np.unique(np.stack([sizes, width], 1)[sizes > 1], axis=0).tolist():  # cells of one size together
                starts = begin[:-1][(sizes == n) & (width == w)]
                step = max(1, min(PAIRS // (n * n), 16 * PAIRS // (n * max(w, 1))))
                for k in range(0, len(starts), step):
                    rows = starts[k : k + step, None] + np.arange(n)
                    x = np.frombuffer(b"".join(units.take(pa.array(rows.ravel())).to_pylist()), np.float64).reshape(*rows.shape, w)
                    # A little under the bound: the blocks below decide on their own.
                    label = stacked_labels(x @ x.transpose(0, 2, 1) >= cosine - 1e-9)
                    g, i = np.nonzero(label != np.arange(n))
                    pairs = [pa.array(ids[rows[g, i]]), pa.array(ids[rows[g, label[g, i]]])]
                    yield pa.RecordBatch.from_arrays(pairs, names=["a", "b"])

    # Sorted, so that a task walks over whole batches of cells.
    dealt = dealt.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "member")
    found = stage(dealt.mapInArrow(meet, "a long, b long").distinct(), "vec-candidates")
    groups = components(found, "vec-groups")
    sizes = groups.groupBy("component_id").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("chunks"))
    blocks = chunked(groups.join(sizes, "component_id"), "component_id", "chunks")
    blocks = blocks.join(same.select("member", "copies"), "member")
    dealt = blocks.join(reps.select(F.col("vec_id").alias("member"), "unit"), "member")
    dealt = dealt.select("component_id", "lo", "hi", "own", "member", "copies", "unit")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("member")
        ids, x, own = pdf["member"].to_numpy(), _matrix(pdf), pdf["own"].to_numpy()
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        if pdf["lo"].iloc[0] != pdf["hi"].iloc[0]:
            near &= own[:, None] != own[None, :]  # pairs inside a chunk have a block of their own
        n = near @ pdf["copies"].to_numpy().astype(np.float64)
        to = ids.copy()
        for i, k in local_links(near):
            to[i] = ids[k]
        return pd.DataFrame({"a": ids, "b": to, "n": n.astype(np.int64)})

    sums = stage(dealt.groupBy("component_id", "lo", "hi").applyInPandas(count, "a long, b long, n long"), "vec-links")
    joined = components(sums.select("a", "b").distinct(), "vec-components")
    linked = sums.groupBy(F.col("a").alias("member")).agg(F.sum("n").alias("n"))
    named = same.join(linked, "member", "left").join(joined, "member", "left").select(
        "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "member").alias("c")
    )
    out = small.join(named, ["d1", "d2"], "left")
    lone = F.col("vec_id").isNull() | F.col("d1").isNull()
    component = F.when(lone, F.col("vec_id")).otherwise(F.col("c"))
    links = F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long")
    return out.select(
        "vec_id", links.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
