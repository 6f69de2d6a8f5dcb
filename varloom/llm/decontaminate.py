"""Benchmark decontamination: latent semantic retrieval of windows, then subsequence and answer checks."""

from __future__ import annotations

import re
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.words import Words, raw, slices, split, words_of
from varloom.session import stage

RANKS = (32, 256)  # of the latent space: one for ``TERMS_PER_RANK`` terms of the items, inside these bounds
TERMS_PER_RANK = 96
COSINE = 0.45  # of a window and an item in the latent space; kept words give about their share, and ``LIKELY`` is 0.5
STEP = 8  # words between the starts of two windows
PASSAGE = 32  # words of a passage that counts as one row of the TF-IDF matrix
SURE = 0.7  # shared subsequence, as a share of the item's words
LIKELY = 0.5  # enough together with the answer
NEED = 0.3  # of the words that must be met, the share that must be met among the rarer ones
HITS = 1 << 21  # meetings of a word and an item that are laid out at a time
ITEMS = 5_000  # items searched for in one pass
DENSE = 4_096  # terms up to which passages are multiplied as dense rows
LOT = 2_048  # blocks whose windows are compared together


def make_index(items: pa.Table) -> SimpleNamespace:
    """The items of one pass as arrays: ids (null too), words, answers, terms. Bounded by ``ITEMS`` items."""
    items = items.sort_by([("item_id", "ascending"), ("text", "ascending")]).combine_chunks()
    texts = [t or "" for t in items["text"].to_pylist()]
    words = split(*raw(pa.array(texts, pa.large_string())))
    last = [re.split(r"(?<=[.!?])\s+|\n", t.strip())[-1] for t in texts]
    tail = split(*raw(pa.array(last, pa.large_string())))
    ids = pa.array(items["item_id"].to_pylist(), pa.int64())
    return SimpleNamespace(ids=ids, seqs=_rows(words), answers=_rows(tail), terms=np.unique(words.hashes()))


def _rows(words: Words) -> list[np.ndarray]:
    h = words.hashes()
    return [h[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def _numbers(terms: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and its number among the items' words or -1."""
    h = words.hashes()
    if not len(terms):
        return h, np.full(len(h), -1)
    at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    return h, np.where(terms[at] == h, at, -1)


def _idf(df: np.ndarray, passages: int) -> np.ndarray:
    """Smoothed, never 0: a word of every passage still tells where an item may be."""
    return (np.log((passages + 1) / (df + 1)) + 1e-2).astype(np.float32)


def _set_basis(index: SimpleNamespace, product: np.ndarray) -> None:
    """Orthonormal columns that span the sampled range; items are laid into it."""
    q, _ = np.linalg.qr(product.astype(np.float64) + 1e-9 * np.random.default_rng(1).normal(size=product.shape))
    index.basis = (q * index.idf[:, None]).astype(np.float32)
    rows = [index.basis[np.searchsorted(index.terms, s)].sum(0) if len(s) else np.zeros(q.shape[1]) for s in index.seqs]
    vectors = np.array(rows, np.float32).reshape(len(index.seqs), q.shape[1])
    index.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _passages(words: Words, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Passage and term of each known word, once per passage; how many passages there are."""
    per = -(-words.counts() // PASSAGE)
    start = np.concatenate([[0], np.cumsum(per)])
    place = np.arange(len(number)) - words.first[:-1][words.texts()] if len(number) else number
    passage = start[words.texts()] + place // PASSAGE if len(number) else number
    known = number >= 0
    key = np.unique(passage[known] * (1 << 32) + number[known])
    return key >> 32, key & 0xFFFFFFFF, int(start[-1])


def _times_itself(passage: np.ndarray, term: np.ndarray, n: int, probe: np.ndarray, total: np.ndarray) -> None:
    """Adds N'(N probe) to ``total``, for the rows of N (passages) given by their terms, in order of passage."""
    if len(probe) <= DENSE:
        for a in range(0, n, 1024):
            lo, hi = np.searchsorted(passage, [a, a + 1024])
            rows = np.zeros((1024, len(probe)), np.float32)
            rows[passage[lo:hi] - a, term[lo:hi]] = 1
            total += rows.T @ (rows @ probe)
    elif len(term):
        new = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        y = np.add.reduceat(probe[term], new, axis=0)
        row = np.cumsum(np.concatenate([[0], (passage[1:] != passage[:-1]).astype(np.int64)]))
        order = np.argsort(term, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(term[order]) != 0]))
        total[term[order][new]] += np.add.reduceat(y[row[order]], new, axis=0)


def places(a: np.ndarray) -> dict[int, int]:
    """For each word of ``a`` its places, as bits."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    return where


def lcs(a: np.ndarray, b: np.ndarray, where: dict[int, int] | None = None, least: float = 0) -> int:
    """Length of the longest common subsequence, with the rows of the table kept as bits of one integer.

    0 if the places of ``a`` whose word occurs in ``b`` at all are fewer than ``least``: then it cannot be longer.
    """
    where = places(a) if where is None else where
    words = b.tolist()
    if least:
        met = 0
        for x in where.keys() & set(words):
            met |= where[x]
        if met.bit_count() < least:
            return 0
    full = (1 << len(a)) - 1
    row = full
    for x in words:
        m = row & where.get(x, 0)
        row = (row + m | row - m) & full
    return len(a) - row.bit_count()


def _set_posts(index: SimpleNamespace, df: np.ndarray) -> None:
    """The words by which each item is looked for, and how often a window has to hold them.

    ``LIKELY`` of an item's words must be met. The most frequent words are left out as long as some must still be met
    without them, so a window that passes the check holds at least ``need`` of the others: nothing is lost.
    """
    item, term, need = [], [], np.zeros(len(index.seqs), np.int64)
    for i, seq in enumerate(index.seqs):
        if not len(seq):
            continue
        own, times = np.unique(np.searchsorted(index.terms, seq), return_counts=True)
        least = int(np.ceil(LIKELY * len(seq) - 1e-9))
        spare, keep = least - max(1, round(NEED * least)), np.ones(len(own), bool)
        for k in np.argsort(-df[own], kind="stable").tolist():
            if times[k] <= spare:
                spare -= times[k]
                keep[k] = False
        need[i] = least - times[~keep].sum()
        item.append(np.full(keep.sum(), i))
        term.append(own[keep])
    none = np.zeros(0, np.int64)
    index.need, index.post_item, index.post_term = need, np.concatenate([none, *item]), np.concatenate([none, *term])
    length = np.array([len(s) for s in index.seqs], np.int64)
    index.sizes = np.maximum(1, np.round(length / STEP)).astype(np.int64)
    # A short item may lie across a window's border.
    index.wider = np.where(length < 5 * STEP, index.sizes + 1, index.sizes)


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. for n[0] numbers, then those from first[1], and so on."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n


def _candidates(index: SimpleNamespace, number: np.ndarray, block: np.ndarray, blocks: int):
    """Items and first blocks of all windows, a block of margin on both sides, that hold enough of the item's words."""
    known = np.flatnonzero(number >= 0)
    known = known[np.argsort(number[known], kind="stable")]
    times = np.bincount(number[known], minlength=len(index.terms))
    border = np.concatenate([[0], np.cumsum(times)])
    places = block[known]
    total = np.cumsum(np.bincount(index.post_item, weights=times[index.post_term], minlength=len(index.seqs)).astype(np.int64))
    lot = (total // HITS)[index.post_item]
    for k in np.unique(lot):
        mine = np.flatnonzero((lot == k) & (times[index.post_term] > 0))
        term = index.post_term[mine]
        hits = np.repeat(index.post_item[mine] * blocks, times[term]) + places[_spread(border[term], times[term])]
        hits.sort()
        item = hits // blocks
        # A window that holds enough begins, at the latest, with its first hit.
        end = np.searchsorted(hits, hits + index.wider[item] + 2)
        full = np.flatnonzero(end - np.arange(len(hits)) >= index.need[item])
        wide = index.wider[item[full]]
        at = np.unique(_spread(hits[full] - wide, wide + 2)) if len(full) else full
        item = at // blocks
        held = np.searchsorted(hits, at + index.wider[item] + 1) - np.searchsorted(hits, at - 1)
        at, item = at[held >= index.need[item]], item[held >= index.need[item]]
        yield item, at - item * blocks


def _near(index: SimpleNamespace, number: np.ndarray, block: np.ndarray, blocks: int, held: np.ndarray):
    """Places in ``held`` and cosines of the windows near an item in the latent space.

    A window's vector is a difference of running sums over blocks. ``LOT`` windows are compared with all items at a time,
    however long the text; of those near an item, the ones in ``held`` (sorted item x blocks + first block) are given.
    """
    known = np.flatnonzero(number >= 0)
    at, term = block[known], number[known]
    widest = int(index.wider.max(initial=1))
    some = np.array([len(s) > 0 for s in index.seqs], bool)
    item, first = np.divmod(held, blocks)
    order = np.argsort(first, kind="stable")
    lots = np.searchsorted(first[order], np.arange(0, blocks + LOT, LOT))
    column = np.full(len(index.seqs), -1)
    for a in range(0, blocks, LOT):
        b = min(blocks, a + LOT + widest)
        lo, hi = np.searchsorted(at, [a, b])
        if lo == hi:
            continue
        sums = np.zeros((b - a + 1, index.basis.shape[1]), np.float32)
        own = at[lo:hi] - a
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums[own[new] + 1] = np.add.reduceat(index.basis[term[lo:hi]], new, axis=0)
        run = np.cumsum(sums, axis=0, dtype=np.float64)
        wanted = order[lots[a // LOT] : lots[a // LOT + 1]]
        for size in np.unique(np.concatenate([index.sizes, index.wider])):
            mine = np.flatnonzero(((index.sizes == size) | (index.wider == size)) & some)
            n = min(LOT, b - a - size + 1)
            if not len(mine) or n <= 0:
                continue
            window = (run[size : size + n] - run[:n]).astype(np.float32)
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            norm[norm <= 1e-6] = np.inf
            near = window @ index.vectors[mine].T
            column[:] = -1
            column[mine] = np.arange(len(mine))
            which = wanted[(column[item[wanted]] >= 0) & (first[wanted] - a < n)]
            kept = np.zeros(near.shape, bool)
            kept[first[which] - a, column[item[which]]] = True
            kept &= near >= (np.float32(COSINE) * norm)[:, None]
            i, j = np.divmod(np.flatnonzero(kept), len(mine))
            yield np.searchsorted(held, mine[j] * blocks + a + i), near[i, j] / norm[i]


def _search(index: SimpleNamespace, words: Words) -> list[tuple]:
    """(text, item, share, cosine, answered) for the windows that are near an item and pass the checks."""
    h, number = _numbers(index.terms, words)
    if not len(h) or not len(index.terms):
        return []
    # Words are laid out in blocks of STEP per text, with room before and behind each text for the longest window.
    room = int(index.wider.max(initial=1)) + 1
    per = -(-words.counts() // STEP)
    start = np.cumsum(per + room) - per
    text = words.texts()
    block = start[text] + (np.arange(len(h)) - words.first[:-1][text]) // STEP
    blocks = int(start[-1] + per[-1] + room)
    # Of the windows near an item, those that hold too few of its words need no table.
    held = [items * blocks + ats for items, ats in _candidates(index, number, block, blocks)]
    held = np.unique(np.concatenate([np.zeros(0, np.int64), *held]))
    if not len(held):
        return []
    cosine = np.full(len(held), -1.0)
    for at, near in _near(index, number, block, blocks, held):
        cosine[at] = np.maximum(cosine[at], near)
    items, ats = np.divmod(held[cosine >= 0], blocks)
    cosine = cosine[cosine >= 0]
    owner = np.searchsorted(start, ats, side="right") - 1
    good = (owner >= 0) & (ats < start[owner] + per[owner])
    best: dict[tuple[int, int], tuple] = {}
    known_places: dict[int, dict[int, int]] = {}
    for item, at, t, near in zip(items[good].tolist(), ats[good].tolist(), owner[good].tolist(), cosine[good].tolist(), strict=True):
        a = int(words.first[t] + (at - start[t]) * STEP)
        seq = index.seqs[item]
        piece = h[max(words.first[t], a - STEP) : min(words.first[t + 1], a + (index.wider[item] + 1) * STEP)]
        if item not in known_places:
            known_places[item] = places(seq)
        share = lcs(seq, piece, known_places[item], LIKELY * len(seq)) / len(seq)
        if share < LIKELY:
            continue
        answer = index.answers[item]
        answered = len(answer) > 0 and lcs(answer, piece) == len(answer)
        if share >= SURE or answered:
            best[t, item] = max(best.get((t, item), (share, near, answered)), (share, near, answered))
    return [(t, item, *v) for (t, item), v in best.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS, rank: int | None = None) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, cosine, lcs_share, answered.

    Words of the items span the term space. One scan over all passages (``PASSAGE`` words each) of all documents takes document
    frequencies and the product of the incidence matrix and its transpose with a random matrix; weighted by TF-IDF, its
    orthonormal range is the latent space, whose rank grows with the items' terms (``RANKS``). Tasks send partial sums only.
    Every window of every document, of about an item's length and ``STEP`` words apart, is compared with the items there, and
    is a candidate from a cosine of ``COSINE`` on. Candidates that hold too few of the item's words to pass are dropped by
    an exact bound (``_set_posts``); then the longest common subsequence decides: ``SURE`` of the item's words, or ``LIKELY``
    of them and its last sentence as the answer. Items are taken ``items_per_pass`` at a time, so what is broadcast stays
    bounded; documents are never shuffled.

    Null and empty texts hold nothing; null or empty items are found nowhere. Rows with the same doc_id are searched
    one by one and give one row per item, the best; rows of one item_id are searched for one by one as well. A null doc_id or
    item_id is kept as a key. No items or documents: no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    parts = max(1, -(-items.count() // items_per_pass))
    found = None
    for p in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).toArrow()
        one = _pass(docs, make_index(own), rank)
        found = one if found is None else found.union(one)
    keys = [F.max(F.struct("lcs_share", "cosine", "answered")).alias("b")]
    return found.groupBy("doc_id", "item_id").agg(*keys).select("doc_id", "item_id", "b.cosine", "b.lcs_share", "b.answered")


def _pass(docs: DataFrame, index: SimpleNamespace, rank: int | None) -> DataFrame:
    context = docs.sparkSession.sparkContext
    texts = docs.select("text")
    n_terms = len(index.terms)
    rank = rank or min(max(n_terms // TERMS_PER_RANK, RANKS[0]), RANKS[1])
    shared = context.broadcast(index)

    def scan(batches):
        index = shared.value
        probe = np.random.default_rng(0).normal(size=(n_terms, rank)).astype(np.float32)
        total, df, passages = np.zeros((n_terms, rank)), np.zeros(n_terms, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                words = words_of(part)
                passage, term, n = _passages(words, _numbers(index.terms, words)[1])
                df += np.bincount(term, minlength=n_terms)
                passages += n
                _times_itself(passage, term, n, probe, total)
        full = np.flatnonzero(df)
        rows = [total[t].astype(np.float32).tobytes() for t in full] + [b""]
        counts = pa.array(np.append(df[full], passages), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1), pa.int64()), counts, pa.array(rows, pa.binary())], names=["term", "n", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        width = 0 if pdf["term"].iloc[0] < 0 else rank
        rows = np.frombuffer(b"".join(pdf["row"]), np.float32).reshape(len(pdf), width)
        return pd.DataFrame({"term": pdf["term"].iloc[:1], "n": [pdf["n"].sum()], "row": [rows.sum(0, dtype=np.float64).astype(np.float32).tobytes()]})

    kind = "term long, n long, row binary"
    sums = texts.mapInArrow(scan, kind).groupBy("term").applyInPandas(add, kind).toArrow()
    df, product, passages = np.zeros(n_terms), np.zeros((n_terms, rank), np.float32), 0
    for t, n, row in zip(*(sums[c].to_pylist() for c in ("term", "n", "row")), strict=True):
        if t < 0:
            passages = n
        else:
            df[t], product[t] = n, np.frombuffer(row, np.float32)
    index.idf = _idf(df, passages)
    _set_posts(index, df)
    _set_basis(index, product * index.idf[:, None])
    ready = context.broadcast(index)

    def search(batches):
        index = ready.value
        for batch in batches:
            for part in slices(batch):
                hits = _search(index, words_of(part))
                t, item = (pa.array([x[k] for x in hits], pa.int64()) for k in (0, 1))
                checks = [pa.array([x[k] for x in hits], pa.float64()) for k in (3, 2)] + [pa.array([bool(x[4]) for x in hits], pa.bool_())]
                columns = [part.column(0).take(t), index.ids.take(item), *checks]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "cosine", "lcs_share", "answered"])

    schema = "doc_id long, item_id long, cosine double, lcs_share double, answered boolean"
    return stage(docs.mapInArrow(search, schema), "leaks")
