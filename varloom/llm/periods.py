"""Runs of periodically repeated words in whole texts, and the texts with each run collapsed to its first period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from varloom.llm.words import Words, slices, words_of

TIMES = 4  # a run holds its period at least so often
LEAST = 6  # words of a run at least
ROUNDS = 64  # of splitting; what is left after them is scanned as it is, which finds the same runs


def frequent_segments(ids: np.ndarray, segment: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Positions that survive the splitting, and the segment each lies in.

    ``ids`` are the words, ``segment`` the text of each. Every word of a run of ``times`` periods occurs ``times`` times in
    it, so a word met less often in its segment is in no run of that segment: it goes and splits the segment there.
    The parts are counted anew until no word goes. Only parts of segments that have just been split are counted again.
    """
    place = np.arange(len(ids))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    label = 0
    for _ in range(ROUNDS):
        if not len(place):
            break
        # Parts: neighbours in the text that belong to one segment.
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])
        part = np.cumsum(new) - 1
        long = np.bincount(part)[part] >= least
        place, part = place[long], part[long]
        if not len(place):
            break
        _, word = np.unique(ids[place], return_inverse=True)
        _, pair, count = np.unique(part * (int(word.max()) + 1) + word, return_inverse=True, return_counts=True)
        rare = count[pair] < times
        split = np.zeros(int(part.max()) + 1, bool)
        split[part[rare]] = True
        whole = ~split[part]
        done.append((place[whole], part[whole] + label))
        label += len(split)
        left = ~whole & ~rare
        place, segment = place[left], part[left]
    else:
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])
        done.append((place, np.cumsum(new) - 1 + label))
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, segment = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(place, kind="stable")
    return place[order], segment[order]


def scan_lags(ids: np.ndarray, place: np.ndarray, segment: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run in the segments, in no order.

    A run of period q holds more than q + k words for a power of two k with k/2 < q <= k. The k words from any of its
    places except the last q + k - 1 come next exactly q words later, for a nearer return would be a smaller period. So the
    lags worth scanning are the distances between neighbouring returns of k words that lie in (k/2, k], for each k, and a
    stretch of places with one such distance is a run as long as it can be.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(place):
        return (np.zeros(0, np.int64),) * 3
    begins = np.ones(len(place), bool)
    begins[1:] = segment[1:] != segment[:-1]
    part = np.cumsum(begins) - 1
    size = np.bincount(part)
    end = (np.cumsum(size))[part]  # index behind the segment of each index
    room = size[part]
    _, word = np.unique(ids[place], return_inverse=True)
    _, rank = np.unique(part * (int(word.max()) + 1) + word, return_inverse=True)
    at = np.arange(len(place))  # indexes whose k words lie inside the segment
    k = 1
    while len(at):
        order = np.argsort(rank, kind="stable")
        again = rank[order[1:]] == rank[order[:-1]]
        here, lag = at[order[:-1][again]], at[order[1:][again]] - at[order[:-1][again]]
        fit = (lag <= k) & (2 * lag > k)
        here, lag = here[fit], lag[fit]
        if len(here):
            sort = np.argsort(here)
            here, lag = here[sort], lag[sort]
            new = np.ones(len(here), bool)
            new[1:] = (here[1:] != here[:-1] + 1) | (lag[1:] != lag[:-1])
            first = np.flatnonzero(new)
            period = lag[first]
            length = np.diff(np.append(first, len(here))) - 1 + k + period
            good = length >= np.maximum(least, times * period)
            found.append((place[here[first[good]]], length[good], period[good]))
        # Twice as many words: only where k words return and both halves lie inside a segment that can hold such a period.
        met = np.zeros(int(rank.max()) + 1, np.int64)
        np.add.at(met, rank, 1)
        table = np.full(len(place), -1, np.int64)
        table[at[met[rank] > 1]] = rank[met[rank] > 1]
        go = (table[at] >= 0) & (at + 2 * k <= end[at]) & (room[at] >= times * (k + 1))
        at = at[go]
        other = table[at + k]
        at, other = at[other >= 0], other[other >= 0]
        if len(at):
            _, rank = np.unique(table[at] * len(met) + other, return_inverse=True)
        k *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs_of(words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (word number in the text), length and period of every run, by text, start and period."""
    place, segment = frequent_segments(ids, words.texts())
    start, length, period = scan_lags(ids, place, segment)
    text = np.searchsorted(words.first, start, side="right") - 1
    order = np.lexsort((period, start))
    return text[order], (start - words.first[text])[order], length[order], period[order]


def collapsed(words: Words, kept: np.ndarray) -> pa.Array:
    """Each text as its kept words, joined by single spaces."""
    starts, sizes, texts = words.starts[kept], (words.ends - words.starts)[kept], words.texts()[kept]
    last = np.ones(len(starts), bool)
    last[:-1] = texts[1:] != texts[:-1]
    width = sizes + ~last
    begin = np.cumsum(width) - width
    source = np.repeat(starts - begin, width) + np.arange(int(width.sum()))
    out = words.data[np.minimum(source, len(words.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[(begin + sizes)[~last]] = 32
    offsets = np.zeros(words.n_texts + 1, np.int64)
    np.cumsum(np.bincount(texts, weights=width, minlength=words.n_texts).astype(np.int64), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), words.n_texts, [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with n_words, runs (start, length, period; by start, then period) and the collapsed text.

    A word is a maximal run of characters other than space and tab to carriage return; words are numbered from 0 and compared
    byte by byte through 64-bit hashes. A run is a stretch of words whose smallest period is q (words q apart are
    identical), of at least max(6, 4 q) words, that no neighbouring word extends. The collapsed text leaves out what a run
    holds after its first q words, and joins the rest by single spaces.

    One pass over whole texts, no shuffle; a task works on 2 MB of text at a time, or on one longer text. A null or empty text
    has no words, no runs and an empty collapsed text. Equal or null keys are rows of their own; no row is lost. Columns
    not kept are ignored, so names cannot clash.
    """
    names = list(keep)
    rows = docs.select(*names, docs[text].alias("__text"))
    kind = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]], "n_words long"])
    kind += ", runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                words = words_of(part, "__text", fold=False)
                text_no, start, length, period = runs_of(words, words.hashes())
                first = words.first[text_no] + start
                edge = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(edge, first + period, 1)
                np.add.at(edge, first + length, -1)
                kept = np.cumsum(edge)[:-1] == 0
                fields = [pa.array(x, pa.int64()) for x in (start, length, period)]
                flat = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
                borders = np.searchsorted(text_no, np.arange(words.n_texts + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(borders), flat)
                columns = [part.column(i) for i in range(len(names))]
                columns += [pa.array(words.counts(), pa.int64()), listed, collapsed(words, kept).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, kind)
