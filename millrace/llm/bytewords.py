"""Words of many texts at once, cut at single bytes of their UTF-8 form, as numpy arrays.

For patterns whose separators are ASCII bytes no text needs decoding: other characters have no byte below
128. A word's hash sums a mixed value of each (place, byte), so that no rule of the text makes hashes
meet; ``equal_words`` and ``dense_ids`` compare bytes where the answer must not stand on hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import mix

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Places in a word whose bytes' values lie in a table.
PLACES = 64

SPACES = b" \t\n\x0b\x0c\r"


def byte_set(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


@functools.cache
def _mixed() -> np.ndarray:
    return mix(np.arange(PLACES * 256, dtype=np.uint64) + np.uint64(1))


@dataclass
class Slice:
    """Rows ``first`` to ``first + len(bounds) - 1`` of a batch: their bytes, and the words in them."""

    first: int
    data: np.ndarray
    # Where each text begins in ``data`` (one entry more than texts).
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # Index of the first word of each text (one entry more than texts).
    cuts: np.ndarray

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends, seed)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, separators: np.ndarray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in slices of about ``size`` bytes."""
    data, bounds = buffers(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield cut(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], separators)
        first = last


def by_slice(function: Callable[[pa.RecordBatch, Slice], pa.RecordBatch | None], separators: np.ndarray):
    """A function for mapInArrow over batches with a column text, which works on a slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in slices(batch.column("text"), separators):
                made = function(batch, found)
                if made is not None and made.num_rows:
                    yield made

    return run


def cut(first: int, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> Slice:
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Slice(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def gathered_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes in a row, and where each begins (one entry more than spans)."""
    sizes = ends - starts
    at = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=at[1:])
    return data[np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)], at


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span (of one byte or more) by its bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = (ends - starts).astype(np.int32)
    at = np.cumsum(sizes, dtype=np.int32) - sizes
    place = np.arange(int(sizes.sum(dtype=np.int64)), dtype=np.int32)
    # Where each byte lies in the data, and in its word.
    row = data[place + np.repeat(starts.astype(np.int32) - at, sizes)]
    place -= np.repeat(at, sizes)
    key = (place << 8) + row
    if int(sizes.max()) <= PLACES:
        value = _mixed()[key]
    else:
        near = place < PLACES
        value = _mixed()[np.where(near, key, 0)]
        far = np.flatnonzero(~near)
        value[far] = mix(key[far].astype(np.uint64) + np.uint64(1))
    salt = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    return mix(np.add.reduceat(value, at) ^ salt)


def equal_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each word has the bytes of word ``other``."""
    out = (ends - starts) == (ends - starts)[other]
    ask = np.flatnonzero(out & (other != np.arange(len(starts))))
    mine, at = gathered_bytes(data, starts[ask], ends[ask])
    theirs, _ = gathered_bytes(data, starts[other[ask]], ends[other[ask]])
    wrong = np.add.reduceat(mine != theirs, at[:-1]) > 0 if len(ask) else np.zeros(0, dtype=bool)
    out[ask[wrong]] = False
    return out


def dense_ids(found: Slice) -> np.ndarray:
    """A number for each word, equal exactly where the words are equal bytes."""
    seed = 0
    while True:
        _, first, ids = np.unique(found.hashes(seed), return_index=True, return_inverse=True)
        if equal_words(found.data, found.starts, found.ends, first[ids]).all():
            return ids
        seed += 1


def texts_column(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string column."""
    row, at = gathered_bytes(data, starts, ends)
    made = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(row)))
    return made.cast(pa.string())


def joined_words(found: Slice, kept: np.ndarray) -> pa.Array:
    """For each text its words with ``kept`` set, joined by one space."""
    starts, ends = found.starts[kept], found.ends[kept]
    owner = found.owners()[kept]
    more = np.zeros(len(owner), dtype=np.int64)
    if len(owner) > 1:
        more[1:] = owner[1:] == owner[:-1]
    sizes = ends - starts
    at = np.cumsum(sizes + more) - sizes
    total = int(at[-1] + sizes[-1]) if len(owner) else 0
    out = np.full(total, ord(" "), dtype=np.uint8)
    row, begin = gathered_bytes(found.data, starts, ends)
    out[np.arange(len(row)) + np.repeat(at - begin[:-1], sizes)] = row
    bounds = np.zeros(len(found.cuts), dtype=np.int64)
    np.cumsum(np.bincount(owner, weights=sizes + more, minlength=len(found.cuts) - 1).astype(np.int64), out=bounds[1:])
    return pa.LargeStringArray.from_buffers(len(found.cuts) - 1, pa.py_buffer(bounds), pa.py_buffer(out)).cast(pa.string())
