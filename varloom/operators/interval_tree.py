"""Interval joins by an implicit tree: every interval is kept once, whatever its length, and points stay where they are.

Intervals are sorted by start inside tiers of similar length, with the running maximum of their ends beside them. Starts and
running ends both grow, so the intervals of a tier that may hold a point lie between two binary searches; tiers keep that
stretch short when a few long intervals enclose many small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators.hints import MAX_BROADCAST_BYTES, table_bytes
from varloom.operators.ranges import range_join

HOWS = ("inner", "left", "left_semi", "left_anti")
OUT_ROWS = 65_536  # rows of one result batch


def tree_join(
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
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Points with the intervals that hold them: the rows of ``range_join``, with the same options.

    The intervals travel to the tasks once, if their measured size is at most ``max_bytes``; one that spans a chromosome is
    one row there, where ``range_join`` lists it once per bin. The points are neither shuffled nor listed more than once, so
    a hot position costs nothing extra, and results leave in batches of bounded size. Larger interval tables are joined
    by ``range_join``. Points with a null chromosome or position lie in no interval; intervals with a null bound, or that
    hold no position, hold no point.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}")
    kept = points.columns
    extra = [] if how in ("left_semi", "left_anti") else [c for c in intervals.columns if c not in kept]
    lo, hi = F.col(start).cast("long") + (shift - pad), F.col(stop).cast("long") + (shift + pad)
    listed = intervals.select(F.col(chrom).alias("__chrom"), lo.alias("__lo"), hi.alias("__hi"), *extra)
    listed = listed.where("__chrom is not null and __lo <= __hi")
    if table_bytes(listed) > max_bytes:
        options = {"pos": pos, "start": start, "stop": stop, "chrom": chrom, "shift": shift, "pad": pad}
        return range_join(points, intervals, how, **options, strategy="shuffle_merge")
    context = points.sparkSession.sparkContext
    sent = context.broadcast(listed.toArrow())
    out_schema = points.join(intervals.select(*extra).limit(0), F.lit(True), "left").select(*kept, *extra).schema
    wanted, limit = (kept.index(chrom), kept.index(pos)), OUT_ROWS

    # The functions below refer only to each other and to installed packages, so executors need no copy of this one.
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        table = sent.value.combine_chunks()
        los = table.column("__lo").to_numpy()
        his = table.column("__hi").to_numpy()
        names = table.column("__chrom").to_pandas().to_numpy()
        tier = np.floor(np.log2(his - los + 1) / 2).astype(np.int64)
        trees = {}  # chromosome -> per tier (starts, running ends, ends, rows)
        for name in np.unique(names.astype(str)) if len(names) else []:
            of = np.flatnonzero(names == name)
            for t in np.unique(tier[of]):
                rows = of[tier[of] == t]
                rows = rows[np.lexsort((rows, los[rows]))]
                trees.setdefault(name, []).append((los[rows], np.maximum.accumulate(his[rows]), his[rows], rows))

        def matches(name, at):
            """(index into ``at``, interval row) of every interval that holds a position."""
            for starts, running, ends, rows in trees.get(name, ()):
                begin = np.searchsorted(running, at, side="left")
                end = np.maximum(np.searchsorted(starts, at, side="right"), begin)
                edge = np.append(0, np.cumsum(end - begin))
                first = 0
                while first < len(at):  # as many points as make about ``limit`` candidates
                    last = max(first + 1, int(np.searchsorted(edge, edge[first] + 16 * limit, side="right")) - 1)
                    size = end[first:last] - begin[first:last]
                    point = np.repeat(np.arange(first, last), size)
                    place = np.arange(len(point)) - np.repeat(edge[first:last] - edge[first], size) + np.repeat(begin[first:last], size)
                    good = ends[place] >= at[point]
                    yield point[good], rows[place[good]]
                    first = last

        def result(batch, point, row):
            columns = [batch.column(i).take(pa.array(point)) for i in range(batch.num_columns)]
            for c in extra:
                taken = table.column(c).take(pa.array(row, pa.int64(), mask=row < 0))
                columns.append(taken.combine_chunks() if isinstance(taken, pa.ChunkedArray) else taken)
            return pa.RecordBatch.from_arrays(columns, names=[*kept, *extra])

        for batch in batches:
            code = batch.column(wanted[0])
            at = batch.column(wanted[1])
            known = pc.and_(code.is_valid(), at.is_valid()).to_numpy(zero_copy_only=False)
            encoded = code.dictionary_encode()
            which = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            values = at.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            met = np.zeros(batch.num_rows, bool)
            for k, name in enumerate(encoded.dictionary.to_pylist()):
                rows_of = np.flatnonzero((which == k) & known)
                for point, row in matches(name, values[rows_of]):
                    point = rows_of[point]
                    met[point] = True
                    if how in ("inner", "left"):
                        for i in range(0, len(point), limit):
                            yield result(batch, point[i : i + limit], row[i : i + limit])
            if how != "inner":
                rest = np.flatnonzero(met if how == "left_semi" else ~met)
                if len(rest):
                    yield result(batch, rest, np.full(len(rest), -1))

    return points.mapInArrow(run, out_schema)
