"""Near-duplicate documents by SuperMinHash signatures, banding, full verification and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm import shingles as S
from varloom.llm.blocks import chunked, components, local_links, shared_counts, stacked_labels, whole_groups
from varloom.llm.words import binary_rows, list_column, signed, slices, words_of
from varloom.session import stage

POSITIONS = 96
BAND_ROWS = 4
#: Margin below the threshold at which a pair's estimate no longer makes it a candidate: over four standard errors.
MARGIN = 0.18
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 400_000
PAIRS = 1 << 18  # pairs of signatures compared together


def signature_rows(docs: DataFrame, size: int, positions: int, band_rows: int) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, compact signature, band keys: one row per input row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                value, first = S.shingle_sets(words_of(part), size)
                signature = S.superminhash(value, first, positions)
                d1, d2 = S.digests(value, first)
                keys = signed(S.band_keys(signature, band_rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(signed(d1)),
                        pa.array(signed(d2)),
                        binary_rows(S.compact(signature)),
                        list_column(keys.ravel(), np.arange(len(keys) + 1) * keys.shape[1], pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "signature", "bands"],
                )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, signature binary, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and its sorted shingle hashes as bytes."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                value, first = S.shingle_sets(words_of(part), size)
                offsets = pa.py_buffer(np.asarray(first * 8, np.int32))
                sets = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, offsets, pa.py_buffer(value.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, shingles binary")


def candidate_links(sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect what may be similar: members of a band bucket whose signatures agree often enough."""
    keyed = sets.select("doc_id", F.explode("bands").alias("bucket"))
    full = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    full = full.withColumn("chunks", F.ceil(F.col("n") / BLOCK_MEMBERS)).drop("n")
    members = keyed.join(full, "bucket").withColumnRenamed("doc_id", "member")
    blocks = chunked(members, "bucket", "chunks").withColumnRenamed("member", "doc_id")
    # A pair of members needs no signature beside its block: all of them are compared at once.
    dealt = blocks.join(sets.select("doc_id", "signature"), "doc_id").select("bucket", "lo", "hi", "doc_id", "signature")
    least = threshold - MARGIN

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin in whole_groups(batches, 3):
            ids = batch.column(3).to_numpy()
            sizes = np.diff(begin)
            width = len(batch.column(4)[0].as_py()) // 2
            signature = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16).reshape(len(ids), width)
            for n in np.unique(sizes[sizes > 1]).tolist():  # buckets of one size together
                starts = begin[:-1][sizes == n]
                step = max(1, PAIRS // (n * n))
                for k in range(0, len(starts), step):
                    rows = starts[k : k + step, None] + np.arange(n)
                    sig = np.ascontiguousarray(signature[rows].transpose(2, 0, 1))
                    agree = np.zeros((len(rows), n, n), np.int16)
                    for one in sig:
                        agree += one[:, :, None] == one[:, None, :]
                    label = stacked_labels(agree >= least * width)
                    g, i = np.nonzero(label != np.arange(n))
                    pairs = [pa.array(ids[rows[g, i]]), pa.array(ids[rows[g, label[g, i]]])]
                    yield pa.RecordBatch.from_arrays(pairs, names=["a", "b"])

    # Sorted, so that a task walks over whole batches of buckets; the smallest doc_id of a bucket comes first.
    sorted_blocks = dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "doc_id")
    return sorted_blocks.mapInArrow(compare, "a long, b long")


def verified_links(docs: DataFrame, groups: DataFrame, sizes: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) that connect the pairs with 100 * intersection >= percent * union, inside groups of candidates."""
    members = groups.join(sizes, groups["member"] == sizes["doc_id"]).select("component_id", "member", "n_shingles")
    weights = members.groupBy("component_id").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    chunks = F.least("n", F.ceil(F.greatest(F.col("n") / BLOCK_MEMBERS, F.col("total") / BLOCK_SHINGLES)))
    weights = weights.select("component_id", chunks.alias("chunks"))
    blocks = chunked(members.drop("n_shingles").join(weights, "component_id"), "component_id", "chunks")
    sets = full_sets(docs.join(groups.select(F.col("member").alias("doc_id")), "doc_id", "left_semi"), size)
    dealt = blocks.join(sets, blocks["member"] == sets["doc_id"]).select("component_id", "lo", "hi", "doc_id", "shingles")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("doc_id").sort_values("doc_id")
        ids = pdf["doc_id"].to_numpy()
        values = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        if len(ids) == 2:
            both = len(np.intersect1d(values[0], values[1], assume_unique=True))
            linked = 100 * both >= percent * (len(values[0]) + len(values[1]) - both)
            found = [(1, 0)] if linked else []
        else:
            shared = shared_counts(values)
            n = np.array([len(v) for v in values])
            found = local_links(100 * shared >= percent * (n[:, None] + n[None, :] - shared))
        return pd.DataFrame([(ids[i], ids[k]) for i, k in found], columns=["a", "b"], dtype=np.int64)

    return dealt.groupBy("component_id", "lo", "hi").applyInPandas(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, percent: int = 75, size: int = 5, positions: int = POSITIONS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * (shared shingles) >= ``percent`` * (shingles of either); ``component_id`` is the
    smallest doc_id reachable over links, and the document of that id is kept.

    Equal sets are brought down to one document first, by sums with partial sums, so exact copies cost one row each.
    Signatures of ``positions`` numbers, in bands of ``band_rows``, give buckets; a pair at 75 percent shares no bucket
    with a probability of 1e-4 (positions 96, rows 4), one at 80 percent with 3e-6. Inside a bucket signatures are
    compared in bounded blocks, which gives groups of candidates; inside a group the full sets are compared in bounded
    blocks, all pairs of it, so a link depends on no leader or estimate. Groups then close over the links.

    Null or empty text: no shingles, linked with nothing, kept. Rows with the same doc_id count as one document, that
    of the smallest digest. A null doc_id comes back once with a null component and is kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    rows = stage(signature_rows(docs, size, positions, band_rows), "near-signatures")
    pick = F.min(F.struct("d1", "d2", "n_shingles"))
    small = rows.groupBy("doc_id").agg(pick.alias("s")).select("doc_id", "s.*")
    filled = small.where("n_shingles > 0 and doc_id is not null")
    same = stage(filled.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("member")), "near-classes")
    reps = rows.join(
        same.select(F.col("member").alias("doc_id"), "d1", "d2", "n_shingles"), ["doc_id", "d1", "d2", "n_shingles"], "left_semi"
    ).dropDuplicates(["doc_id"])
    reps = stage(reps.select("doc_id", "n_shingles", "signature", "bands"), "near-distinct")
    found = stage(candidate_links(reps, percent / 100).distinct(), "near-candidates")
    groups = components(found, "near-groups")
    checked = stage(verified_links(docs, groups, reps.select("doc_id", "n_shingles"), percent, size).distinct(), "near-links")
    joined = components(checked, "near-components")
    named = same.join(joined, "member", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component_id", "member").alias("component_id")
    )
    out = small.join(named, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(component).cast("long")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )
