"""Words of whole texts as 64-bit hashes, computed on the bytes of an Arrow column with numpy.

A word is a maximal run of bytes other than space and tab to carriage return; A-Z are lowered. Two different words get
the same hash with a probability of about 2^-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + U64((seed * int(ODD)) % (1 << 64)))


class Cache(dict):
    """Tables worked out once per task; it travels to the executors empty."""

    def __reduce__(self):
        return dict, ()


CACHE: dict = Cache()


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Is a byte a separator, its lower case, its random value."""
    if "tables" in CACHE:
        return CACHE["tables"]
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    CACHE["tables"] = space, lower, mix(np.arange(1, 257, dtype=U64))
    return CACHE["tables"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if n in CACHE:
        return CACHE[n]
    base = int(ODD) | 1
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, U64(b))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    CACHE[n] = out[0], out[1]
    return CACHE[n]


def _span(n: int) -> int:
    """Power tables come in few sizes, so that they are reused."""
    return max(SLICE_BYTES * 2, 1 << (n + 1).bit_length())


@dataclass
class Words:
    """Words of some texts; ``first[d]`` to ``first[d + 1]`` are those of text d."""

    data: np.ndarray  # lowered bytes of all texts
    offsets: np.ndarray  # where each text begins; one more entry than texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    sums: np.ndarray  # running polynomial hash, one longer than data

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(self.n_texts), self.counts())

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes from each start to its end."""
        inverse = powers(_span(len(self.data)))[1]
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts] + (ends - starts).astype(U64))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)


def split(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> Words:
    """The words of texts laid end to end; ``fold`` lowers A-Z first."""
    space, lower, value = tables()
    data = lower[data] if fold else data
    is_word = ~space[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = is_word[inner]
    finishes = is_word.copy()
    finishes[:-1] &= ~is_word[1:]
    finishes[inner - 1] = is_word[inner - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(value[data] * powers(_span(len(data)))[0][: len(data)], out=sums[1:])
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), sums)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text comes alone."""
    offsets = raw(batch.column(batch.schema.get_field_index(text)))[1]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def words_of(batch: pa.RecordBatch, text: str = "text", fold: bool = True) -> Words:
    return split(*raw(batch.column(batch.schema.get_field_index(text))), fold)


def list_column(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row borders."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(first, np.int32)), pa.array(values, kind))


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    rows = np.ascontiguousarray(matrix)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
