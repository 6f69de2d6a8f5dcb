"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.words import U64, Words, list_column, mix, signed, slices, words_of
from varloom.session import stage

SHORT = 320  # words with an output of their own
CLASSES = 96  # outputs of the other words, by their first three bytes
WIDTH = 16
RECENT = 16  # words in the long part of the context
NOISE = 48  # noise draws shared by the tokens of a batch
BATCH = 1024
SCORED = 512  # tokens scored at a time
SAFE = 40.0  # outputs up to this need no shift before the exponential
RATE = 0.15
FREQUENT = 400_000  # words whose counts travel with every task
SMOOTH = 0.1
END = int(signed(mix(np.array([2024], U64)))[0])


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash and class of every token, with an end token behind each text; where each text begins."""
    n = words.n_texts
    first = words.first + np.arange(n + 1)
    value = np.full(first[-1], END, np.int64)
    kind = np.zeros(first[-1], np.int64)
    place = np.arange(len(words.starts)) + words.texts()
    value[place] = signed(words.hashes())
    head = words.span_hash(words.starts, np.minimum(words.ends, words.starts + 3))
    kind[place] = (head % U64(CLASSES)).astype(np.int64)
    return value, kind, first


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash), class and n over all texts, the end token included; tasks send the sums of their own words."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            value = np.concatenate([h[0] for h in held])
            keys, at, back = np.unique(value, return_index=True, return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([h[2] for h in held]), minlength=len(keys)).astype(np.int64)
            return keys, np.concatenate([h[1] for h in held])[at], n

        def rows(keys, kind, n):
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(kind.astype(np.int32)), pa.array(n)], names=["word", "class", "n"])

        for batch in batches:
            for part in slices(batch):
                value, kind, _ = _tokens(words_of(part))
                keys, at, n = np.unique(value, return_index=True, return_counts=True)
                held.append((keys, kind[at], n))
                if sum(len(h[0]) for h in held) > 1_000_000:
                    held[:] = [merged()]
                    if len(held[0][0]) > 500_000:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged())

    found = texts.mapInArrow(run, "word long, class int, n long")
    return found.groupBy("word").agg(F.first("class").alias("class"), F.sum("n").alias("n"))


def _ids(value: np.ndarray, kind: np.ndarray, model: SimpleNamespace) -> np.ndarray:
    """Output of each token: its own among the short list, else that of its class."""
    at = np.minimum(np.searchsorted(model.words, value), len(model.words) - 1)
    return np.where(model.words[at] == value, at, len(model.words) + kind)


def _known(value: np.ndarray, ids: np.ndarray, model: SimpleNamespace, known: np.ndarray, known_n: np.ndarray):
    """Whether each token's word is among the known ones, and its count there; words of the short list are sought once."""

    def sought(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        here = known[at] == words
        return here, np.where(here, known_n[at], 0)

    (here, c), own = sought(model.words), np.minimum(ids, len(model.words) - 1)
    here, c = here[own], c[own]
    other = np.flatnonzero(ids >= len(model.words))
    here[other], c[other] = sought(value[other])
    return here, c


def _begins(first: np.ndarray) -> np.ndarray:
    """The first token of each token's text."""
    return np.repeat(first[:-1], np.diff(first))


def _context(ids: np.ndarray, begins: np.ndarray, model: SimpleNamespace, start: int, stop: int):
    """Context vectors of tokens start to stop, with their parts: last word, word before it, mean of recent words."""
    i = np.arange(start, stop)
    begin = begins[start:stop]
    r, end = model.inputs, model.end
    one = np.where(i - 1 >= begin, ids[i - 1], end)
    two = np.where(i - 2 >= begin, ids[i - 2], end)
    low = max(0, start - RECENT)
    run = np.zeros((stop - low + 1, WIDTH), np.float32)
    np.cumsum(r.take(ids[low:stop], axis=0), axis=0, out=run[1:])
    since = np.maximum(begin, i - RECENT)
    count = np.maximum(i - since, 1).astype(np.float32)
    mean = run[start - low : stop - low] - run.take(since - low, axis=0)
    mean /= count[:, None]
    last, before = r.take(one, axis=0), r.take(two, axis=0)
    h = last * model.scale[0]
    h += before * model.scale[1]
    h += mean * model.scale[2]
    return h, last, before, mean, count


def _step(ids, begins, start, stop, model, memory, rng) -> None:
    """One update from a batch of tokens: each against shared noise words drawn by frequency."""
    h, last, before, mean, count = _context(ids, begins, model, start, stop)
    target, size = ids[start:stop], stop - start
    noise = np.searchsorted(model.heap, rng.random(NOISE)).clip(0, len(model.bias) - 1)
    shift = np.log(NOISE) + model.logp
    own, drawn = model.outputs.take(target, axis=0), model.outputs[noise]
    good = np.einsum("ij,ij->i", h, own) + (model.bias - shift)[target]
    eg = (1 / (1 + np.exp(np.clip(good, -30, 30)))).astype(np.float32)  # ascent direction of the true words
    # In place, because the noise makes the largest arrays; what the bound leaves out is 1 at this precision.
    eb = h @ -drawn.T
    eb -= (model.bias - shift)[noise]
    np.minimum(eb, np.float32(30), out=eb)
    np.exp(eb, out=eb)
    eb += np.float32(1)
    np.reciprocal(eb, out=eb)  # descent direction of the noise
    n, width = len(model.bias), np.arange(WIDTH)
    low, begin = max(0, start - RECENT), begins[start:stop]
    cells = (ids[low:stop, None] * WIDTH + width).ravel()

    def spread(at: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=g.ravel(), minlength=n * WIDTH).reshape(n, WIDTH)

    gh = eg[:, None] * own - eb @ drawn
    drawn_cells = (noise[:, None] * WIDTH + width).ravel()
    g_out = spread(cells[(start - low) * WIDTH :], eg[:, None] * h) - spread(drawn_cells, eb.T @ h)
    g_bias = np.bincount(target, weights=eg, minlength=n) - np.bincount(noise, weights=np.ones(size, np.float32) @ eb, minlength=n)
    g_scale = np.stack([np.einsum("ij,ij->j", gh, x) for x in (last, before, mean)])
    # What each word of the batch and before it gets as the last word, the word before it and one of the recent words of those
    # after it in its text: the mean passes its gradient to all words of its stretch, a difference of running sums.
    i = np.arange(start, stop)
    total = np.zeros((size + 1, WIDTH))
    np.cumsum(gh * (model.scale[2] / count[:, None]), axis=0, dtype=np.float64, out=total[1:])
    place = np.arange(low, stop)
    until = np.minimum(np.searchsorted(begin, place, side="right"), np.maximum(place + RECENT + 1 - start, 0))
    back = total.take(until, axis=0) - total.take(np.clip(place + 1 - start, 0, size), axis=0)
    ended = np.zeros(WIDTH)
    for away, scale in ((1, model.scale[0]), (2, model.scale[1])):
        given = gh * scale
        outside = i - away < begin
        if outside.any():
            ended += given[outside].sum(axis=0, dtype=np.float64)
            given[outside] = 0
        skip = max(0, low + away - start)  # those before the first word of all belong to the end
        back[start + skip - away - low : stop - away - low] += given[skip:]
    g_in = spread(cells, back)
    g_in[model.end] += ended
    for name, g in (("inputs", g_in), ("outputs", g_out), ("bias", g_bias), ("scale", g_scale)):
        g = g / size
        memory[name] += g * g
        move = RATE * g / (np.sqrt(memory[name]) + 1e-4)
        setattr(model, name, (getattr(model, name) + move).astype(np.float32))


PARTS = ("inputs", "outputs", "bias", "scale")


def _fit(texts: DataFrame, model: SimpleNamespace) -> SimpleNamespace:
    """One pass over all training texts: every task trains from the same start; parameters are averaged by tokens."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(model)

    def run(batches):
        model = SimpleNamespace(**vars(shared.value))
        memory = {name: np.full_like(getattr(model, name), 1e-6, dtype=np.float64) for name in PARTS}
        rng, seen = np.random.default_rng(3), 0
        for batch in batches:
            for part in slices(batch):
                value, kind, first = _tokens(words_of(part))
                ids, begins = _ids(value, kind, model), _begins(first)
                for start in range(0, len(ids), BATCH):
                    _step(ids, begins, start, min(start + BATCH, len(ids)), model, memory, rng)
                seen += len(ids)
        if seen:
            flat = [getattr(model, name).astype(np.float64) * seen for name in PARTS]
            lines = [x.tobytes() for x in flat]
            yield pa.RecordBatch.from_arrays([pa.array(range(4), pa.int32()), pa.array(lines, pa.binary()), pa.array([seen] * 4, pa.int64())], names=["part", "total", "n"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.float64) for x in pdf["total"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "total": [total.tobytes()], "n": [pdf["n"].sum()]})

    kind = "part int, total binary, n long"
    sent = texts.mapInArrow(run, kind)
    # Sums meet in two levels, so that no task adds up what all tasks sent.
    level = sent.withColumn("lot", F.spark_partition_id() % 64).groupBy("part", "lot").applyInPandas(lambda pdf: add(pdf), kind)
    for part, total, n in level.groupBy("part").applyInPandas(add, kind).toPandas().itertuples(index=False):
        old = getattr(model, PARTS[part])
        setattr(model, PARTS[part], (np.frombuffer(total, np.float64) / n).astype(np.float32).reshape(old.shape))
    return model


def _logp(ids: np.ndarray, first: np.ndarray, model: SimpleNamespace) -> np.ndarray:
    """Normalised log10 probability of each token's output, by products of batches with the output matrix.

    A batch stays in the processor's cache. Its outputs are shifted by their greatest only where some could grow too large
    for the exponential: none is above the context's length times that of the longest output, and the bias.
    """
    begins, out = _begins(first), np.empty(len(ids))
    table = np.ascontiguousarray(np.vstack([model.outputs.T, model.bias[None, :]]))
    rows, ones = np.arange(SCORED), np.ones(table.shape[1], np.float32)
    longest, most = np.linalg.norm(model.outputs, axis=1).max(), np.abs(model.bias).max()
    for start in range(0, len(ids), SCORED):
        stop = min(start + SCORED, len(ids))
        h = np.ones((stop - start, WIDTH + 1), np.float32)
        h[:, :WIDTH] = _context(ids, begins, model, start, stop)[0]
        z = h @ table
        own = z[rows[: stop - start], ids[start:stop]]
        far = np.sqrt(np.einsum("ij,ij->i", h[:, :WIDTH], h[:, :WIDTH]).max()) * longest + most > SAFE
        top = z.max(axis=1) if far else np.float32(0)
        if far:
            z -= top[:, None]
        np.exp(z, out=z)
        out[start:stop] = (own - top - np.log(z @ ones)) / np.log(10)
    return out


def scored(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Counts of all words of the training texts (those for which ``learn`` holds) stay a distributed table; ``FREQUENT``
    words at most, chosen by a bound on the count, travel with the tasks. ``base_score`` is the smoothed unigram log10
    probability. The model predicts from the last two words and the mean of the recent ones one of ``SHORT`` frequent
    words (the end among them) or one of ``CLASSES`` classes of the others; within a class, words go by their counts,
    with a share for an unknown word. It is trained on all training texts and normalised exactly, so ``score`` is the
    log10 probability of the whole text. Counts of rarer words meet their documents by a join on the word.

    Null text counts as empty: one token, the end. Without training texts every word is unknown. Rows with a null or
    repeated doc_id are scored like others. Other columns are ignored; empty input gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    train = (docs if learn is None else docs.where(learn)).select("text")
    counts = stage(word_counts(train), "lm-counts")
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(totals["n"] or 0), int(totals["v"])
    short = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(SHORT - 1).toPandas()
    end_n = counts.where(F.col("word") == END).agg(F.sum("n")).first()[0] or 0
    words = np.concatenate([short["word"].to_numpy(np.int64), [END]])
    order = np.argsort(words)
    words, own = words[order], np.concatenate([short["n"].to_numpy(np.int64), [end_n]])[order]
    tail = counts.where(~F.col("word").isin([int(w) for w in words]))
    kinds = tail.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    class_n[kinds["class"].to_numpy()] = kinds["n"].to_numpy()
    class_v[kinds["class"].to_numpy()] = kinds["v"].to_numpy()
    # The number of words by size of count, in steps of a quarter of a doubling: a few hundred rows at most.
    step = F.floor(F.log2("n") * 4)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.min("n").alias("n")).toPandas().sort_values("step", ascending=False)
    fits = sizes[sizes["v"].cumsum() <= FREQUENT]
    cutoff = int(fits["n"].min()) if len(fits) else 1 << 62
    table = counts.where(F.col("n") >= cutoff).select("word", "n").toPandas().sort_values("word")

    mass = np.concatenate([own, class_n + SMOOTH * (class_v + 1)]) + 0.01
    p = mass / mass.sum()
    rng = np.random.default_rng(5)
    n_out = len(p)
    model = SimpleNamespace(
        words=words, end=int(np.flatnonzero(words == END)[0]), logp=np.log(p).astype(np.float32), heap=np.cumsum(p),
        inputs=rng.normal(0, 0.3, (n_out, WIDTH)).astype(np.float32), outputs=rng.normal(0, 0.05, (n_out, WIDTH)).astype(np.float32),
        bias=np.log(p).astype(np.float32), scale=np.full((3, WIDTH), 0.5, np.float32),
    )
    model = _fit(train, model)
    z_all = np.log10(n_all + SMOOTH * (v_all + 1))
    z_class = np.log10(class_n + SMOOTH * (class_v + 1))
    shared = context.broadcast((model, table["word"].to_numpy(np.int64), table["n"].to_numpy(np.int64), z_all, z_class))

    def run(batches):
        model, known, known_n, z_all, z_class = shared.value
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                value, kind, first = _tokens(words_of(part))
                text = np.repeat(np.arange(n), np.diff(first))
                ids = _ids(value, kind, model)
                here, c = _known(value, ids, model, known, known_n)
                inner = ids >= len(model.words)  # words that go by their class
                logc = np.log10(c + SMOOTH)
                score = _logp(ids, first, model) + np.where(inner, -z_class[np.where(inner, ids - len(model.words), 0)], 0.0)
                score += np.where(inner & here, logc, 0.0)
                base = np.where(here, logc, 0.0) - z_all
                total = lambda x: np.bincount(text, weights=x, minlength=n)
                away = np.flatnonzero(~here)
                rare_order = np.lexsort((value[away], text[away]))
                t, w, own = text[away][rare_order], value[away][rare_order], inner[away][rare_order]
                new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (w[1:] != w[:-1])])) if len(t) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([new, [len(t)]]))
                borders = np.searchsorted(t[new], np.arange(n + 1))
                rare = [list_column(x, borders, k) for x, k in ((w[new], pa.int64()), (times, pa.int32()), (own[new].astype(np.int8), pa.int8()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first), pa.int64()), pa.array(total(c > 0).astype(np.int64)), pa.array(total(base)), pa.array(total(score)), *rare],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "words", "times", "inner"],
                )

    kind = "doc_id long, n_tokens long, n_known long, base_score double, score double, words array<long>, times array<int>, inner array<tinyint>"
    rows = stage(docs.mapInArrow(run, kind).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times", "inner")).alias("w")).select("row", "w.*")
    met = rare.join(counts.where(F.col("n") < cutoff).select(F.col("word").alias("words"), "n"), "words", "left")
    c = F.coalesce("n", F.lit(0))
    log = F.log10(c + SMOOTH) * F.col("times")
    sums = met.groupBy("row").agg(
        F.sum(log).alias("more_base"), F.sum(F.when(F.col("inner") == 1, log).otherwise(0.0)).alias("more_score"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known")
    )
    out = rows.drop("words", "times", "inner").join(sums, "row", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select(
        "doc_id", "n_tokens", plus("n_known", "more_known"), F.lit(n_all).cast("long").alias("train_tokens"), plus("base_score", "more_base"), plus("score", "more_score")
    )
