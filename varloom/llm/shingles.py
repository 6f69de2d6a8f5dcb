"""Sets of word shingles and their SuperMinHash signatures."""

from __future__ import annotations

import numpy as np

from varloom.llm.words import U64, Words, mix, seeded

ELEMENTS = 60_000  # elements handled together; bounds the permutation table


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, flat and sorted within a text, and their borders.

    A text with fewer words than ``size`` has one shingle, its whole word sequence; one without words has none.
    """
    h = words.hashes()
    n = words.counts()
    texts = words.texts()
    place = np.arange(len(h)) - words.first[:-1][texts] if len(h) else np.zeros(0, np.int64)
    left = n[texts] - place  # words from here to the end of the text
    value = seeded(h, 1)
    for k in range(1, size):
        more = left > k
        step = mix(value[more] * U64(0xD6E8FEB86659FD93) + h[np.flatnonzero(more) + k])
        value[more] = step
    full = (left >= size) | ((place == 0) & (n[texts] < size))
    value, texts = value[full], texts[full]
    order = np.lexsort((value, texts))
    value, texts = value[order], texts[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (texts[1:] != texts[:-1])
    value, texts = value[new], texts[new]
    return value, np.searchsorted(texts, np.arange(words.n_texts + 1))


def superminhash(value: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """Signature of each set, ``m`` numbers: the smallest of (step + draw) over the elements at each position.

    Every element visits the positions in its own random order, one per step, with a fresh draw in [0, 1) added to the
    step. A set is finished after the step at which all its positions hold a number below the next step, for no later
    draw can be smaller. Empty sets keep infinity.
    """
    out = np.full((len(first) - 1, m), np.inf)
    begin = 0
    while begin < len(first) - 1:
        end = int(np.searchsorted(first, first[begin] + ELEMENTS, side="right")) - 1
        end = min(max(end, begin + 1), len(first) - 1)
        _signatures(value[first[begin] : first[end]], first[begin : end + 1] - first[begin], m, out[begin:end])
        begin = end
    return out


def _signatures(value: np.ndarray, first: np.ndarray, m: int, out: np.ndarray) -> None:
    sets = np.repeat(np.arange(len(first) - 1), np.diff(first))
    flat = out.reshape(-1)
    order = None  # permutation of each active element, from the second step on
    for step in range(m):
        if not len(value):
            return
        draw = seeded(value, step + 7)
        pick = ((draw & U64(0xFFFFF)) % U64(m - step)).astype(np.int64) + step
        number = (draw >> U64(20)).astype(np.float64) / float(1 << 44) + step
        rows = np.arange(len(value))
        if order is None:
            position = pick
        else:
            position = order[rows, pick].astype(np.int64)
        np.minimum.at(flat, sets * m + position, number)
        done = out.max(axis=1) < step + 1
        active = ~done[sets]
        if step == 0:
            value, sets, pick = value[active], sets[active], pick[active]
            order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(value), 1))
            rows = np.arange(len(value))
            order[rows, pick] = 0
        else:
            order[rows, pick] = order[:, step]  # the visited position is not met again
            value, sets, order = value[active], sets[active], order[active]


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` consecutive positions."""
    n, m = signature.shape
    bits = np.ascontiguousarray(signature).view(U64).reshape(n, m // rows, rows)
    key = np.broadcast_to(mix(np.arange(m // rows, dtype=U64)), (n, m // rows)).copy()
    for r in range(rows):
        key = mix(key * U64(0xD6E8FEB86659FD93) + bits[:, :, r])
    return key


def digests(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums that identify a set."""
    out = []
    for seed in (101, 102):
        sums = np.zeros(len(value) + 1, U64)
        np.cumsum(seeded(value, seed), out=sums[1:])
        out.append(sums[first[1:]] - sums[first[:-1]])
    return out[0], out[1]


def compact(signature: np.ndarray) -> np.ndarray:
    """16 bits of each number, to estimate the share of equal positions."""
    return (mix(np.ascontiguousarray(signature).view(U64)) & U64(0xFFFF)).astype(np.uint16).reshape(signature.shape)
