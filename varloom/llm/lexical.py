"""Ranked lexical search: documents are scanned with an automaton of all item terms, and scored where they are read."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.words import raw, slices
from varloom.session import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MAX_PAIRS = 100_000  # pairs of item and term that travel to the tasks together
TOP = 10
SALT = 64  # parts of an item's candidates that are ranked on their own first


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """(item_id, term), each pair once. Rows of one item_id, null too, are one item with the terms of all its texts."""
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = items.select("item_id", F.explode(F.split(lowered, SEPARATORS)).alias("term"))
    return terms.where("term <> ''").distinct()


def guarded(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray]:
    """Texts laid end to end, lowered, every separator a space and a space around each text; where each text begins.

    Bytes stand for characters: those of a separator are below 128 and in no longer character.
    """
    letter = np.zeros(256, bool)
    letter[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    shown = np.where(letter, np.arange(256), 32).astype(np.uint8)
    shown[0x41:0x5B] += 32
    out = np.full(len(data) + len(offsets), 32, np.uint8)
    out[np.arange(len(data)) + 1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = shown[data]
    return out.tobytes().decode("latin-1"), offsets + np.arange(len(offsets))


def term_counts(text: str, begins: np.ndarray) -> np.ndarray:
    """Terms of each text, with repeats."""
    space = np.frombuffer(text.encode("latin-1"), np.uint8) == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    return np.diff(np.searchsorted(starts, begins))


class Scanner:
    """The boundary-guarded automaton of some terms; made in a task."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.n = len(terms)

    def counts(self, text: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, term number, occurrences), by text. Guards are shared: ' a ' and ' b ' both end inside ' a b '."""
        met = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        document = np.searchsorted(begins, met[:, 0] - 1, side="right") - 1
        key, tf = np.unique(document * self.n + met[:, 1], return_counts=True)
        return key // self.n, key % self.n, tf


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, str, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, "__text"):
            yield part, *guarded(*raw(part.column(part.schema.get_field_index("__text"))))


def corpus_counts(docs: DataFrame, terms) -> DataFrame:
    """(term number, df) over all documents; number -1 has the documents with a term, -2 all terms with repeats.

    Counts are summed in each task first, so a task sends a row per term it has met at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms.value)
        df = np.zeros(scanner.n, np.int64)
        held = length = 0
        for _, text, begins in parts(batches):
            n = term_counts(text, begins)
            held, length = held + int((n > 0).sum()), length + int(n.sum())
            df += np.bincount(scanner.counts(text, begins)[1], minlength=scanner.n)
        met = np.flatnonzero(df)
        columns = [pa.array(np.append(met, [-1, -2]), pa.int64()), pa.array(np.append(df[met], [held, length]), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "df"])

    return docs.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Best:
    """The best documents of each item so far: higher score first, then smaller doc_id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.rows = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray, missing: np.ndarray) -> None:
        item, score, doc_id, missing = (np.concatenate(x) for x in zip(self.rows, (item, score, doc_id, missing), strict=True))
        order = np.lexsort((doc_id, missing, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        keep = np.arange(len(item)) - first < self.top
        self.rows = [item[keep], *[x[order][keep] for x in (score, doc_id, missing)]]

    def batch(self, salt: int) -> pa.RecordBatch:
        item, score, doc_id, missing = self.rows
        columns = [pa.array(item, pa.int64()), pa.array(doc_id, pa.int64(), mask=missing), pa.array(score, pa.int64())]
        columns.append(pa.array(np.full(len(item), salt), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score", "salt"])


def scores(counts: tuple[np.ndarray, np.ndarray, np.ndarray], m: np.ndarray, weight: np.ndarray, first: np.ndarray, items: np.ndarray):
    """(text number, item number, score), scores above 0 only. ``items[first[t]:first[t + 1]]`` are the items of term t."""
    document, term, tf = counts
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[document]))
    n_items = int(items.max(initial=0)) + 1
    size = np.diff(first)[term]
    row = np.repeat(np.arange(len(term)), size)
    to = items[np.repeat(first[term] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    key, inverse = np.unique(document[row] * n_items + to, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, inverse, part[row])
    good = total > 0
    return key[good] // n_items, key[good] % n_items, total[good]


def scored(docs: DataFrame, sent, top: int) -> DataFrame:
    """The ``top`` best documents of each item in each task: (item, doc_id, score, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sent.value
        scanner, best = Scanner(given["terms"]), Best(top)
        for part, text, begins in parts(batches):
            n = term_counts(text, begins)
            # Python's whole numbers: the product can pass 64 bits before the division.
            m = np.array([10 + 90 * x * given["N"] // given["L"] if x else 10 for x in n.tolist()], np.int64)
            document, item, score = scores(scanner.counts(text, begins), m, given["weight"], given["first"], given["items"])
            ids = part.column(0).cast(pa.int64())
            missing = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            best.add(item, score, values[document], missing[document])
        context = TaskContext.get()
        yield best.batch(0 if context is None else context.partitionId() % SALT)

    return docs.mapInArrow(run, "item long, doc_id long, score long, salt long")


def ranked_block(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame | None:
    """The ranking for the items of one block of (item_id, term) pairs, whose number is bounded; None for an empty block."""
    context = docs.sparkSession.sparkContext
    rows = pairs.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"]))
    terms = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    link = np.array([(number[t], i) for i, r in enumerate(rows) for t in r["terms"]], np.int64).reshape(-1, 2)
    link = link[np.lexsort((link[:, 1], link[:, 0]))]
    counted = {r["term"]: r["df"] for r in corpus_counts(docs, context.broadcast(terms)).collect()}
    n, length = counted.get(-1, 0), counted.get(-2, 0)
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(terms))]
    first = np.searchsorted(link[:, 0], np.arange(len(terms) + 1))
    sent = context.broadcast(
        {"terms": terms, "weight": np.array(weight, np.int64), "first": first, "items": link[:, 1], "N": n, "L": max(length, 1)}
    )
    found = scored(docs, sent, top)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for group in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)
    named = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    return found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of digits, letters of ASCII (lowered) and characters beyond ASCII. A term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's share of it 10^9 tf / (1000 tf + 8 m) rounded down, with
    m = 10 + 90 n N / L rounded down; a score sums weight times share over the item's terms. Equal scores go by doc_id.

    All documents are scanned twice, once for N, L and df, once for the scores; no index and no row per document and term
    is made. Items are dealt by hash into blocks of about ``max_pairs`` pairs of item and term (one larger item is a block
    of its own size), and a block's automaton travels with the tasks. A task keeps the best documents of each item, which are
    ranked in 64 parts and then together, so no task ranks more than parts x tasks x ``top`` rows.

    A null text has no term and a document without terms no score. Rows of one item_id, null too, are one item; an item
    without terms is not listed. Rows that repeat a doc_id are ranked one by one, a null doc_id comes last among equal
    scores. Empty tables give no rows; other columns are ignored. ``doc_id`` is a whole number.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").alias("__text"))
    pairs = stage(item_terms(items), "item-terms")
    total = pairs.count()
    blocks = -(-2 * total // max_pairs) if total > max_pairs else min(total, 1)
    found = None
    for b in range(blocks):
        block = ranked_block(rows, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), top)
        if block is None:
            continue
        block = stage(block, "ranked") if blocks > 1 else block
        found = block if found is None else found.unionByName(block)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


#: The same ranking in SQL, over ``documents`` and ``benchmark``.
ORACLE = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT row_no, doc_id, terms, CAST(coalesce(len(terms), 0) AS BIGINT) AS n FROM split),
whole AS (SELECT CAST(count_if(n > 0) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
tf AS (SELECT row_no, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM sized) GROUP BY ALL),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, big_n),
scored AS (SELECT item.item_id, tf.row_no, CAST(sum(w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN sized USING (row_no), whole GROUP BY item.item_id, tf.row_no),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
  FROM scored JOIN sized USING (row_no) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
