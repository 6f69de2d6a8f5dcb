"""A letter trigram model and the noisy channel that restores disguised words with it."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.words import Words, raw, slices

LETTERS = 28  # word border, a to z, any other letter or digit
OTHER = 27

# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "",
}
KEEP_COST = math.log(0.05)  # a sign inside a word that stands for itself
LEET_COST = math.log(0.2)
REPEAT_COST = math.log(0.3)  # a letter that is held on to
JOIN_COST = math.log(0.3)  # a separator inside a spaced-out word
BREAK_COST = math.log(0.3)

LETTER = r"[^\W\d_]"
SPACED = re.compile(rf"{LETTER}(?:[ .\-_*]{LETTER}){{3,}}[.,!?]?")
def codes(data: np.ndarray) -> np.ndarray:
    """Letter classes of lowered UTF-8 bytes; a multi-byte letter counts by its first byte, its other bytes are -1."""
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[48:58] = OTHER
    table[128:192] = -1
    table[192:] = OTHER
    return table[data]


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all texts: each task sums its own, then at most 28^3 sums meet."""

    def run(batches):
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            for part in slices(batch):
                data, _ = raw(part.column(0))
                c = codes(data)
                c = c[c >= 0]
                c = np.concatenate([[0, 0], c, [0]])
                c = c[~((c == 0) & (np.roll(c, 1) == 0) & (np.roll(c, 2) == 0))]  # one border pair between words
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["gram", "n"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long")
    rows = found.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(LETTERS**3)
    out[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """Trigram log-probabilities, mixed with bigrams and single letters."""
    c3 = counts.reshape(LETTERS, LETTERS, LETTERS)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + LETTERS)
    p2 = (c2 + 5 * p1[None, :]) / (c2.sum(1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5))


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else OTHER


def restore(token: str, model: np.ndarray, width: int = 64) -> str:
    """The likeliest reading of a disguised token: Viterbi over the lattice of what each sign may stand for.

    A state is the last two letters read and the last letter written; a sign stays, becomes a letter, or is dropped as a
    repetition or as spacing. ``width`` is the number of states kept at a place; the lattice has fewer in practice.
    """
    spaced = SPACED.fullmatch(token) is not None
    states: dict[tuple[int, int, str], tuple[float, str]] = {(0, 0, ""): (0.0, "")}
    for sign in token.lower():
        new: dict[tuple[int, int, str], tuple[float, str]] = {}

        def put(key, score, text, new=new):
            if key not in new or new[key][0] < score:
                new[key] = score, text

        for (a, b, last), (score, text) in states.items():
            if sign.isalpha() or sign.isdigit():
                c = _code(sign)
                cost = 0.0 if sign.isalpha() else KEEP_COST
                put((b, c, sign), score + cost + model[a, b, c], text + sign)
                if sign == last and sign.isalpha():
                    put((a, b, last), score + REPEAT_COST, text)
            elif spaced:
                put((a, b, ""), score + JOIN_COST, text)
                put((b, 0, ""), score + BREAK_COST + model[a, b, 0], text + " ")
            else:
                put((b, 0, ""), score + KEEP_COST + model[a, b, 0], text + sign)
                if sign == "*":
                    put((a, b, last), score + LEET_COST, text)
            for letter in LEET.get(sign, ""):
                c = _code(letter)
                put((b, c, letter), score + LEET_COST + model[a, b, c], text + letter)
                if letter == last:
                    put((a, b, last), score + LEET_COST + REPEAT_COST, text)
        states = dict(sorted(new.items(), key=lambda x: -x[1][0])[:width]) if len(new) > width else new
    return max((score + model[a, b, 0], text) for (a, b, _), (score, text) in states.items())[1]


def disguised(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each stretch that may be disguised, found on the bytes (``data``: letters in their own case).

    A digit beside a letter; a sign between letters or digits, or one that only stands for a letter in front of one; a letter
    three times; letters with separators between them, inside a word or as a row of four words of one letter.
    """
    n = len(data)
    low = words.data
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    digit = (low >= 48) & (low <= 57)
    sign = np.isin(low, np.frombuffer(b"@$!|+(*", np.uint8))
    front = np.isin(low, np.frombuffer(b"@$", np.uint8))
    parts = np.isin(low, np.frombuffer(b".-_*", np.uint8))
    any_ = letter | digit | sign

    def at(mask: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, bool)
        if k > 0:
            out[: max(n - k, 0)] = mask[k:]
        else:
            out[-k:] = mask[: max(n + k, 0)]
        return out

    mark = digit & (at(letter, 1) | at(letter, -1))
    mark |= sign & at(letter | digit, 1) & at(any_, -1) | front & at(letter, 1)
    same = np.zeros(n, bool)
    if n > 2:
        same[: n - 2] = letter[: n - 2] & (low[: n - 2] < 128) & (low[: n - 2] == low[1 : n - 1]) & (low[1 : n - 1] == low[2:])
    mark |= same
    dotted = letter & at(parts, 1) & at(letter, 2)
    mark |= dotted & at(dotted, 2) & at(dotted, 4)
    marked = np.unique(np.searchsorted(words.starts, np.flatnonzero(mark), side="right") - 1)
    marked = marked[marked >= 0]
    size = words.ends - words.starts
    single = letter[words.starts] & ((size == 1) | (size == 2) & (low[words.starts] >= 192))
    joined = np.zeros(len(size), bool)  # one byte between this word and the one before, same text
    joined[1:] = words.starts[1:] == words.ends[:-1] + 1
    joined[words.first[:-1][words.first[:-1] < len(size)]] = False
    linked = single & joined & np.concatenate([[False], single[:-1]])
    edge = np.diff(np.concatenate([[0], linked.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1) - 1
    long = end - begin >= 3
    begin, end = begin[long], end[long]
    inside = np.zeros(len(size) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end + 1, -1)
    free = marked[np.cumsum(inside)[marked] == 0] if len(marked) else marked
    first, last = np.concatenate([begin, free]), np.concatenate([end, free])
    order = np.argsort(first)
    return first[order], last[order]


def readings(data: np.ndarray, words: Words, model: np.ndarray, known: dict[str, str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """First word, last word and likeliest reading of each disguised stretch; ``known`` keeps readings for the task."""
    first, last = disguised(data, words)
    out = []
    for a, b in zip(words.starts[first].tolist(), words.ends[last].tolist(), strict=True):
        token = data[a:b].tobytes().decode("utf-8", "replace")
        if token not in known:
            if len(known) > 100_000:
                known.clear()
            known[token] = restore(token, model)
        out.append(known[token])
    return first, last, out
