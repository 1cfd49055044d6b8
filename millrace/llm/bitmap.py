"""A bitmap that tells which keys may be wanted: what it lets through is settled by a join.

It has eight to sixteen slots for each key, from 128 kB up to 32 MB (``MOST_BITS``, the bound of what reaches
the driver and each worker). Up to 32 million keys at most one key in eight passes without need; beyond, the share
grows (half of all at 190 million keys) and the joins behind it carry more rows, but none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch
from .words import mix

LEAST_BITS, MOST_BITS = 20, 28


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return mix(keys.view(np.uint64)) >> np.uint64(64 - bits)


def bitmap(keys: DataFrame, count: int | None = None, key: Callable[[pa.RecordBatch], np.ndarray] | None = None) -> bytes:
    """A bit set for each key of ``keys``, a staged table: its one column, or what ``key`` makes of its columns.

    ``count``: how many they are, if it is known.
    """
    key = key or (lambda batch: batch.column(0).to_numpy())
    count = keys.count() if count is None else count
    size = min(max(int(8 * count).bit_length(), LEAST_BITS), MOST_BITS)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.unique(slots(key(batch), size))
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["slot"])

    words = (
        keys.mapInArrow(per_batch(place), "slot long")
        .groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    )
    out = np.zeros(1 << (size - 6), dtype=np.uint64)
    found = words.toArrow()
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out.tobytes()


def wanted(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    slot = slots(keys, len(bits).bit_length() + 2)
    words = np.frombuffer(bits, dtype=np.uint64)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def rehashed(keys: np.ndarray, turn: int) -> np.ndarray:
    """The keys for the bitmap of number ``turn`` of a sieve."""
    return mix(keys.view(np.uint64) + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) if turn else keys


def sieve(keys: DataFrame, times: int = 3) -> list[bytes]:
    """Bitmaps of as many hashes, for keys of which some come very often: of others one in hundreds passes at most, up to 32 million keys."""
    count = keys.count()
    return [bitmap(keys, count, lambda batch, i=i: rehashed(batch.column(0).to_numpy(), i)) for i in range(times)]


def sifted(bitmaps: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Places of the keys that pass all bitmaps."""
    at = np.arange(len(keys))
    for turn, bits in enumerate(bitmaps):
        at = at[wanted(bits, rehashed(keys[at], turn))]
    return at


def may_have(keyed: DataFrame, keys: DataFrame, bits: bytes | None = None) -> DataFrame:
    """Rows whose key ``k`` may be among ``keys``; ``bits``: their bitmap, if it is made already."""
    bits = bitmap(keys) if bits is None else bits

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(wanted(bits, batch.column("k").to_numpy())))

    return keyed.mapInArrow(per_batch(pick), keyed.schema)


def without(bits: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key is surely not in the bitmap; for use in a task, as two Python steps in a row are two workers."""
    for batch in batches:
        rest = batch.filter(pa.array(~wanted(bits, batch.column("k").to_numpy())))
        if rest.num_rows:
            yield rest
