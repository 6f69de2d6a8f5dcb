"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.words import U64, mix, slices

BITS = 16
SIZES = (1, 2, 3)
MAX_PER_LANGUAGE = 1000
UNKNOWN = "und"


def letters(text: str | None) -> np.ndarray:
    """Code points of the lowered text; whatever is no letter becomes a space, and runs of spaces one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32) if text else np.zeros(0, np.uint32)
    keep = (points >= 97) & (points <= 122)
    odd = np.flatnonzero(points > 127)
    if len(odd):
        kinds, back = np.unique(points[odd], return_inverse=True)
        keep[odd] = np.array([chr(k).isalpha() for k in kinds.tolist()])[back]
    points = np.where(keep, points, 32)
    stay = keep.copy()
    stay[1:] |= keep[:-1]
    return points[stay]


def _grams(part: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and count of the n-grams of each text; which texts hold a letter."""
    points = [letters(t) for t in part.column(at).to_pylist()]
    texts, features = [], []
    size = np.array([len(p) for p in points])
    has = size > 0
    padded = [np.concatenate([[32], p, [32]]) for p in points]
    flat = np.concatenate(padded).astype(U64) if padded else np.zeros(0, U64)
    owner = np.repeat(np.arange(len(points)), size + 2)
    for n in SIZES:
        key = np.zeros(max(len(flat) - n + 1, 0), U64)
        for k in range(n):
            key = key * U64(0x110001) + flat[k : len(flat) - n + 1 + k]
        inside = owner[: len(key)] == owner[n - 1 :] if len(key) else np.zeros(0, bool)
        texts.append(owner[: len(key)][inside])
        features.append((mix(key[inside] + U64(n)) >> U64(64 - BITS)).astype(np.int64))
    both = np.concatenate(texts) * (1 << BITS) + np.concatenate(features)
    key, count = np.unique(both, return_counts=True)
    text = key >> BITS
    good = has[text]
    return text[good], (key & ((1 << BITS) - 1))[good], count[good], has


def _vectors(text, feature, count, idf, n) -> np.ndarray:
    """TF-IDF values, of length one per text."""
    value = np.log1p(count) * idf[feature]
    norm = np.sqrt(np.bincount(text, weights=value * value, minlength=n))
    return value / np.maximum(norm[text], 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, *, alpha=1.0, beta=1.0, l1=1e-4, l2=1e-3, epochs=3, batch=16) -> np.ndarray:
    """Weights (feature, class) by follow-the-regularised-leader with an elastic net; unused features stay zero."""
    z, n = np.zeros((1 << BITS, k)), np.zeros((1 << BITS, k))
    order = np.random.default_rng(0)

    def weights(at):
        sure = np.abs(z[at]) > l1
        return np.where(sure, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(epochs):
        places = order.permutation(len(y))
        for a in range(0, len(y), batch):
            some = places[a : a + batch]
            features = np.concatenate([rows[i][0] for i in some])
            values = np.concatenate([rows[i][1] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
            at, slot = np.unique(features, return_inverse=True)
            w = weights(at)
            x = np.zeros((len(some), len(at)))
            x[owner, slot] = values
            p = softmax(x @ w)
            p[np.arange(len(some)), y[some]] -= 1
            g = x.T @ p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(1 << BITS))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which the held-back texts are likeliest, from a grid."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def identify(docs: DataFrame, learn: Column | None = None, max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the calibrated probability of the predicted language).

    Document frequencies of the n-grams cover all documents with text for which ``learn`` holds and lang is known.
    The model is fitted on a sample of them: of each language, texts whose hash of doc_id falls under a bound that lets
    about ``max_per_language`` through. A fifth of the sample sets the temperature only.

    Null text, or text without a letter: ``und`` with score 0. With no labelled text all are ``und``; with one language
    all texts with letters get it with score 1. Null or repeated doc_ids are rows like others. Neither lang, source nor
    doc_id is part of a prediction. Empty input gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    context = docs.sparkSession.sparkContext
    known = docs.where("lang is not null and text is not null")
    if learn is not None:
        known = known.where(learn)

    def frequencies(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                _, feature, _, has = _grams(part, 0)
                total += np.bincount(feature, minlength=len(total))
                n += int(has.sum())
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([full, [-1]])), pa.array(np.concatenate([total[full], [n]]))], names=["feature", "n"]
        )

    counts = known.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros((1 << BITS) + 1)
    df[counts["feature"].to_numpy()] = counts["n"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 0.1
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(sizes)
    bound = F.lit(0.0)
    for name, n in sizes.items():
        bound = F.when(F.col("lang") == name, F.lit(max_per_language / n)).otherwise(bound)
    drawn = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 30))
    sample = known.where(drawn < bound * (1 << 30)).select("lang", "text")

    def gather(batches):
        for batch in batches:
            for part in slices(batch):
                text, feature, count, _ = _grams(part, 1)
                value = _vectors(text, feature, count, idf, part.num_rows).astype(np.float32)
                first = np.searchsorted(text, np.arange(part.num_rows + 1))
                pairs = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([feature[a:b].astype(np.int32).tobytes() for a, b in pairs], pa.binary()),
                        pa.array([value[a:b].tobytes() for a, b in pairs], pa.binary()),
                    ],
                    names=["lang", "features", "amounts"],
                )

    got = sample.mapInArrow(gather, "lang string, features binary, amounts binary").toPandas()
    got = got[got["features"].str.len() > 0].sort_values(["lang", "features"], kind="stable")
    weights, heat = np.zeros((1 << BITS, max(len(names), 1))), 1.0
    if len(names) > 1 and len(got):
        rows = [(np.frombuffer(f, np.int32), np.frombuffer(v, np.float32)) for f, v in zip(got["features"], got["amounts"], strict=True)]
        y = np.array([names.index(x) for x in got["lang"]])
        back = np.arange(len(y)) % 5 == 4
        fit = [r for r, b in zip(rows, back, strict=True) if not b]
        weights = ftrl(fit, y[~back], len(names))
        if back.any():
            logits = np.array([weights[f].T @ v for (f, v), b in zip(rows, back, strict=True) if b])
            heat = temperature(logits, y[back])
    shared = context.broadcast((weights.astype(np.float32), heat, names, idf))

    def predict(batches):
        weights, heat, names, idf = shared.value
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                text, feature, count, has = _grams(part, 1)
                value = _vectors(text, feature, count, idf, n)
                logits = np.stack([np.bincount(text, weights=value * weights[feature, k], minlength=n) for k in range(weights.shape[1])], axis=1)
                p = softmax(logits / heat)
                best = p.argmax(axis=1)
                known = has & (len(names) > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([names[b] if h else UNKNOWN for b, h in zip(best.tolist(), known.tolist(), strict=True)], pa.string()),
                        pa.array(np.where(known, p[np.arange(n), best], 0.0)),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
