"""Toxicity of whole texts: disguised words are restored by a noisy channel, then a logistic model scores the words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm import charlm
from varloom.llm.words import U64, Words, seeded, slices, split, words_of

BITS = 20
PREFIXES = (4, 5, 6, 7)
KEPT_FEATURES = 2048
MAX_PER_CLASS = 3000
STRETCH = 100.0  # occurrences are counted per so many words


def _features(words: Words, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature number of each whole word and each prefix; signs in front of a word are passed over."""
    low = words.data
    starts, ends, texts = words.starts[use], words.ends[use], words.texts()[use]
    for _ in range(3):
        odd = (low[starts] < 97) & (ends - starts > 1)
        starts = starts + odd
    out = [(texts, seeded(words.span_hash(starts, ends), 99))]
    for k in PREFIXES:
        long = ends - starts >= k
        out.append((texts[long], seeded(words.span_hash(starts[long], starts[long] + k), k)))
    return np.concatenate([t for t, _ in out]), (np.concatenate([f for _, f in out]) >> U64(64 - BITS)).astype(np.int64)


def _read(part: pa.RecordBatch, model: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text and feature of everything in the restored texts, words per text, readings per text."""
    data, _ = charlm.raw(part.column(part.schema.get_field_index("text")))
    words = words_of(part)
    first, last, said = charlm.readings(data, words, model, known)
    gone = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(gone, first, 1)
    np.add.at(gone, last + 1, -1)
    texts, features = _features(words, np.cumsum(gone)[:-1] == 0)
    owner = words.texts()[first] if len(first) else np.zeros(0, np.int64)
    if said:
        again = [s.encode() for s in said]
        spelled = split(np.frombuffer(b"".join(again), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in again])]).astype(np.int64))
        t, f = _features(spelled, np.ones(len(spelled.starts), bool))
        texts, features = np.concatenate([texts, owner[t]]), np.concatenate([features, f])
    return texts, features, words.counts(), np.bincount(owner, minlength=words.n_texts)


def _tally(texts: np.ndarray, features: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and value of each feature of a text: the log of one plus its occurrences per hundred words."""
    key, count = np.unique(texts * (1 << BITS) + features, return_counts=True)
    text, feature = key >> BITS, key & ((1 << BITS) - 1)
    return text, feature, np.log1p(STRETCH * count / np.maximum(n[text], 1)).astype(np.float32)


def train(rows, prior: float, kept: int = KEPT_FEATURES, steps: int = 400, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of all features (most are zero) and the offset, from sample rows (toxic, features, values).

    The features that tell the classes apart best are kept; the offset is moved to the share of toxic labels."""
    y = rows["toxic"].to_numpy().astype(np.float64)
    weights = np.zeros(1 << BITS, np.float32)
    base = float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
    if len(y) == 0 or y.min() == y.max():
        return weights, base if len(y) else 0.0
    features = [np.frombuffer(x, np.int32) for x in rows["features"]]
    df = [np.bincount(np.concatenate([f for f, t in zip(features, y, strict=True) if t == k] or [np.zeros(0, np.int32)]), minlength=1 << BITS) for k in (0, 1)]
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    gap = (df[1] + 0.1) / (n1 + 0.2) - (df[0] + 0.1) / (n0 + 0.2)
    noise = np.sqrt((df[0] + df[1] + 0.2) / (n0 + n1)) * np.sqrt(1 / n0 + 1 / n1)
    z = np.where(df[0] + df[1] >= 3, np.abs(gap) / noise, 0)
    chosen = np.sort(np.argsort(-z, kind="stable")[: min(kept, int((z > 0).sum()))])
    slot = np.full(1 << BITS, -1, np.int32)
    slot[chosen] = np.arange(len(chosen))
    x = np.zeros((len(y), len(chosen)), np.float32)
    for i, (f, v) in enumerate(zip(features, rows["amounts"], strict=True)):
        s = slot[f]
        x[i, s[s >= 0]] = np.frombuffer(v, np.float32)[s >= 0]
    w, b = np.zeros(len(chosen), np.float32), 0.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    share = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = ((p - y) * share).astype(np.float32)
        g = np.concatenate([x.T @ e + decay * w, [e.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - move[:-1].astype(np.float32), b - move[-1]
    weights[chosen] = w
    return weights, float(b + 0.5 * base)  # half way from even classes to the share of the labels


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 from 0.7), n_restored.

    The letter model counts the trigrams of all texts. The classifier is fitted on a sample of the labelled documents for
    which ``learn`` (of doc_id) holds: of each class, those whose hash of doc_id falls under a bound that lets about
    ``max_per_class`` through; class sizes are counted over all labels. The model is a bounded array, broadcast once.

    A null or empty text has no words and scores the offset alone. A document with several labels is toxic if one says
    so; null labels are ignored; with one class only, every score is the share of toxic labels (0.5 without labels).
    Rows with a null or repeated doc_id are scored like others. Labels, language, source and id are not in the score.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spark = docs.sparkSession
    model = charlm.log_model(charlm.trigram_counts(docs))
    marks = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    if learn is not None:
        marks = marks.where(learn)
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, F.lit(max_per_class / max(sizes.get(1, 0), 1))).otherwise(max_per_class / max(sizes.get(0, 0), 1))
    marks = marks.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < rate * (1 << 30))

    def gather(batches):
        known: dict = {}
        for batch in batches:
            for part in slices(batch):
                texts, features, n, _ = _read(part, model, known)
                text, feature, value = _tally(texts, features, n)
                first = np.searchsorted(text, np.arange(part.num_rows + 1))
                lines = [(feature[a:b].astype(np.int32).tobytes(), value[a:b].tobytes()) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in lines], pa.binary()), pa.array([x for _, x in lines], pa.binary())],
                    names=["toxic", "features", "amounts"],
                )

    # The sample of labels is bounded by max_per_class, so it may be broadcast.
    sample = docs.join(F.broadcast(marks), "doc_id").select("toxic", "text")
    rows = sample.mapInArrow(gather, "toxic int, features binary, amounts binary").toPandas()
    prior = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    weights, offset = train(rows, prior)
    shared = spark.sparkContext.broadcast((model, weights, offset))

    def score(batches):
        model, weights, offset = shared.value
        known: dict = {}
        for batch in batches:
            for part in slices(batch):
                texts, features, n, restored = _read(part, model, known)
                told = weights[features] != 0
                text, feature, value = _tally(texts[told], features[told], n)
                total = np.bincount(text, weights=weights[feature] * value, minlength=part.num_rows) + offset
                p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p), pa.array((p >= 0.7).astype(np.int32)), pa.array(restored.astype(np.int64))],
                    names=["doc_id", "score", "predicted", "n_restored"],
                )

    return docs.mapInArrow(score, "doc_id long, score double, predicted int, n_restored long")
