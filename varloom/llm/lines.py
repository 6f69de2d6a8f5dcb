"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line of those within one edit stays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.words import U64, mix, powers, seeded, signed, slices
from varloom.session import stage

MIN_CHARS = 20  # shorter lines match only exactly
BITS = 27  # of the bitmaps that travel with tasks: 16 MB


def _split(texts: list[str | None]):
    """Code points of all trimmed non-blank lines, their borders, the text and the line number of each."""
    lines, owner, number = [], [], []
    for i, text in enumerate(texts):
        for k, line in enumerate(text.split("\n") if text else []):
            line = line.strip()
            if line:
                lines.append(line)
                owner.append(i)
                number.append(k)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
    return points, first, np.array(owner, np.int64), np.array(number, np.int32), lines


class Sums:
    """Running polynomial hash of code points: hash of any piece of a line."""

    def __init__(self, points: np.ndarray):
        size = max(1 << 22, 1 << (len(points) + 2).bit_length())
        self.power, self.inverse = powers(size)
        self.sums = np.zeros(len(points) + 1, U64)
        np.cumsum(mix(points.astype(U64) + U64(1)) * self.power[: len(points)], out=self.sums[1:])

    def piece(self, a, b):
        return (self.sums[b] - self.sums[a]) * self.inverse[a]


def _line_hash(s: Sums, a, b):
    return mix(s.piece(a, b) + (b - a).astype(U64))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the low bits of all hashes; tasks send the positions they set, once each."""

    spots = hashes.select(F.pmod("h", F.lit(1 << BITS)).cast("int").alias("spot"))
    cell = spots.select(F.shiftright("spot", 6).alias("cell"), F.expr("shiftleft(1L, cast(pmod(spot, 64) as int))").alias("bit"))
    words = cell.groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    lots = words.groupBy(F.shiftright("cell", 12).alias("lot")).agg(F.collect_list(F.struct("cell", "bits")).alias("w"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for row in lots.select("w.cell", "w.bits").toLocalIterator():
        out[np.array(row[0])] = row[1]
    return out.view(U64)


def _in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    spot = h & U64((1 << BITS) - 1)
    return (bits[(spot >> U64(6)).astype(np.int64)] >> (spot & U64(63))) & U64(1) == 1


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, line, h, anchors: a row per non-blank line. Two lines within one edit share an anchor.

    An edit leaves the longer part before or behind it whole; anchors are the front and the back of a line, at the lengths
    of lines as long and one shorter.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                points, first, owner, number, _ = _split(part.column(1).to_pylist())
                s, a, b = Sums(points), first[:-1], first[1:]
                n = b - a
                rows, keys = [], []
                far = n >= MIN_CHARS
                for own, use in (((n - 1) // 2, far), ((n - 2) // 2, far & (n % 2 == 1))):
                    at = np.flatnonzero(use)
                    q = own[at]
                    for seed, x, y in ((1, a[at], a[at] + q), (2, b[at] - q, b[at])):
                        rows.append(at)
                        keys.append(seeded(s.piece(x, y) + q.astype(U64), seed))
                rows, keys = np.concatenate(rows), np.concatenate(keys)
                keys = keys[np.argsort(rows, kind="stable")]
                borders = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(n)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array(number), pa.array(signed(_line_hash(s, a, b))), pa.ListArray.from_arrays(pa.array(borders), pa.array(signed(keys)))],
                    names=["doc_id", "line", "h", "anchors"],
                )

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "doc_id long, line int, h long, anchors array<long>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """h and line of the lines whose hash is in ``wanted``: a bitmap thins them in the scan, a semi-join decides."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches):
        bits = shared.value
        for batch in batches:
            for part in slices(batch):
                points, first, _, _, lines = _split(part.column(0).to_pylist())
                h = _line_hash(Sums(points), first[:-1], first[1:])
                hit = np.flatnonzero(_in_bitmap(bits, h))
                _, at = np.unique(h[hit], return_index=True)
                hit = hit[at]
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[hit])), pa.array([lines[i] for i in hit.tolist()], pa.string())], names=["h", "text"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "h long, text string")
    return found.join(wanted, "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))


def variants(lines: DataFrame) -> DataFrame:
    """key, h, gap, fresh: a line without the character at each of its places, and the line itself (gap -1).

    ``key`` hashes what remains. Lines that differ by one replaced character share key and gap, also inside a run of equal
    characters; a line that misses one character of another is itself that one's key. ``fresh`` marks the first place of
    a run: the others leave the same.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=1 << 17):
                texts = part.column(1).to_pylist()
                points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
                n = np.array([len(t) for t in texts])
                first = np.concatenate([[0], np.cumsum(n)])
                s = Sums(points)
                at = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(points))
                a, b = first[at], first[at + 1]
                fresh = np.ones(len(points), bool)
                fresh[1:] = (points[1:] != points[:-1]) | (at[1:] != at[:-1])
                gap = (i - a).astype(np.int32)
                rest = s.piece(a, i) + s.piece(i + 1, b) * s.power[i - a]
                key = np.concatenate([mix(rest + (b - a - 1).astype(U64)), _line_hash(s, first[:-1], first[1:])])
                h = part.column(0).take(pa.array(np.concatenate([at, np.arange(len(n))])))
                gap = np.concatenate([gap, np.full(len(n), -1, np.int32)])
                fresh = np.concatenate([fresh, np.ones(len(n), bool)])
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), h, pa.array(gap), pa.array(fresh)], names=["key", "h", "gap", "fresh"])

    return lines.select("h", "text").mapInArrow(run, "key long, h long, gap int, fresh boolean")


def within_one(a: str, b: str) -> bool:
    """Is the edit distance one at most?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def shared_keys(spelled: DataFrame) -> DataFrame:
    """Keys of two lines or more. A line has each of its keys in one fresh row, and so only the keys are counted."""
    return spelled.where("fresh").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")


def meetings(spelled: DataFrame) -> DataFrame:
    """h, to (place, h): each variant with the earliest of its bucket, and with the whole line that equals it.

    ``spelled`` has the columns of ``variants`` and ``place``. Distinct lines of one key differ in one character, so a key has
    few of them; one shuffle by key serves both kinds.
    """
    member = F.struct("place", "h")
    lead = F.first(F.struct("gap", "place", "h")).over(Window.partitionBy("key").orderBy("gap", "place", "h"))
    best = F.first(member).over(Window.partitionBy("key", "gap").orderBy("place", "h"))
    met = spelled.select("h", "gap", "fresh", "place", member.alias("member"), lead.alias("own"), best.alias("best")).where("gap >= 0")
    near = F.col("fresh") & (F.col("own.gap") == -1)
    pair = lambda when, h, to: F.when(when, F.struct(F.col(h).alias("h"), to.alias("to")))
    pairs = F.array(
        pair(F.col("best.h") != F.col("h"), "h", F.col("best")),
        pair(near & (F.col("own.place") < F.col("place")), "h", F.struct(F.col("own.place").alias("place"), F.col("own.h").alias("h"))),
        pair(near & (F.col("place") < F.col("own.place")), "own.h", F.col("member")),
    )
    return met.select(F.inline(F.array_compact(pairs)))


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """Lines to remove: doc_id, line, kept_doc_id, kept_line, distance (0 or 1).

    Lines are trimmed; blank ones are left alone. Positions are ordered by doc_id and line. Of equal lines the earliest
    stays. A line of ``MIN_CHARS`` or more goes with all its copies if some earlier line of ``MIN_CHARS`` or more is one
    edit away (a character replaced, added or missing), whether that line itself stays or not; ``kept_*`` names the
    earliest found.

    Equal lines are brought down to one by sums with partial sums. Only lines that share an anchor with another are
    spelled into variants, and only variants whose hash another line has too go on; lines meet on these, each with the
    earliest of its bucket, so a bucket gives a row per member and no pairs; the edit distance of what met is checked on the
    texts.

    Null and empty texts have no lines. Rows that repeat a doc_id stand at the same positions and do not remove each
    other. Null doc_ids are left out. Empty input gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    table = stage(line_table(docs), "lines")
    place = F.struct("doc_id", "line")
    first = stage(table.groupBy("h").agg(F.min(place).alias("place"), F.count("*").alias("n")), "line-first")
    anchors = table.where(F.size("anchors") > 0).select("h", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("anchor")
    wanted = stage(anchors.join(shared, "anchor", "left_semi").select("h").distinct(), "line-wanted")
    texts = stage(_texts(docs, wanted), "line-texts")
    spelled = stage(variants(texts), "line-variants")
    shared = stage(shared_keys(spelled), "line-shared")
    pairs = meetings(spelled.join(shared, "key", "left_semi").join(first.select("h", "place"), "h")).groupBy("h").agg(F.min("to").alias("to"))
    pairs = pairs.select("h", F.col("to.h").alias("to_h"), F.col("to.place").alias("to_place"))
    both = pairs.join(texts, "h").join(texts.select(F.col("h").alias("to_h"), F.col("text").alias("to_text")), "to_h")

    @F.pandas_udf("boolean")
    def checked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_one(x, y) for x, y in zip(a, b, strict=True)])

    near = stage(both.where(checked("text", "to_text")).select("h", "to_place"), "line-near")
    goal = first.join(near, "h", "left").where("n > 1 or to_place is not null")
    goal = goal.select("h", F.coalesce("to_place", "place").alias("to"), F.col("to_place").isNotNull().cast("int").alias("distance"))
    gone = table.select("doc_id", "line", "h").join(goal, "h").where(place != F.col("to"))
    return gone.select("doc_id", "line", F.col("to.doc_id").alias("kept_doc_id"), F.col("to.line").alias("kept_line"), "distance")


def without_duplicate_lines(docs: DataFrame) -> DataFrame:
    """Documents with the lines of ``duplicate_lines`` taken out of their text; other columns stay as they are."""
    gone = duplicate_lines(docs).groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("line").alias("gone_lines"))
    joined = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left")
    lines = F.split(docs["text"], "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(gone["gone_lines"], s["i"]))
    text = F.when(gone["gone_lines"].isNull(), docs["text"]).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return joined.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
