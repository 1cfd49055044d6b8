"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a longest stretch of words with smallest period q (words q apart are equal) that is at least
four periods and six words long.

* A run of period q holds a point of every grid of width 3q, and there word i equals word i + q.
  So all runs show at n/3 (1 + 1/2 + 1/3 + ...) pairs (i, i + q): the harmonic grid. How far such a pair
  goes on being equal to the right and to the left gives the run around it.
* Pairs are first compared over a few words (``NEAR``), which settles nearly all of them. For texts
  that have pairs left, ``Extensions`` answers each at once: of all suffixes only those at the places of a
  difference cover modulo 31 (six of 31) are sorted, by their blocks of 31 words and prefix doubling.
  Two places are at most 30 words before places of the cover, so after a few compared words the rest is
  a range minimum over the sorted suffixes' common blocks (a sparse table), and a few words more.
* A stretch found with a multiple of its period is the same stretch, so the smallest period stays.

Words are numbered within a slice of texts by their bytes (exactly), and blocks of equal hash are
compared, so that no answer stands on hashes. No row needs another one: there is no shuffle.

Defined results: null text counts as empty, and a text without a word has no run. A text of any
length is taken whole. Repeated rows and equal ids give a row each. An empty table gives an empty one. Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import SPACES, Slice, byte_set, dense_ids, joined_words, slices
from .common import refuse_names, register, table
from .words import mix

# A difference cover: every number modulo 31 is a difference of two of these (fixed values).
COVER, MODULUS = (1, 5, 11, 24, 25, 27), 31
NEAR = 8
LEAST_WORDS, LEAST_PERIODS = 6, 4
STEP = LEAST_PERIODS - 1
# Pairs of the grid looked at at once.
PAIRS = 1 << 18

WHITE = byte_set(SPACES)


@functools.cache
def cover_of() -> tuple[np.ndarray, np.ndarray]:
    """For each difference the cover's place to go to, and the number of each of its places."""
    place = np.full(MODULUS, -1)
    place[list(COVER)] = range(len(COVER))
    first = np.zeros(MODULUS, dtype=np.int64)
    for a in COVER:
        for b in COVER:
            first[(b - a) % MODULUS] = a
    return first, place


def equal_ahead(ids: np.ndarray, i: np.ndarray, j: np.ndarray, most, back: bool = False) -> np.ndarray:
    """How many words from i and j on (or, with ``back``, before them) are equal, up to ``most`` (number or array)."""
    out = np.zeros(len(i), dtype=np.int64)
    most = np.broadcast_to(most, i.shape)
    live = np.flatnonzero(most > 0)
    step = 0
    while len(live):
        shift = -1 - step if back else step
        live = live[ids[i[live] + shift] == ids[j[live] + shift]]
        step += 1
        out[live] = step
        live = live[most[live] > step]
    return out


class Extensions:
    """Longest common extensions to the right of places in one array of numbers.

    The array ends in a number found nowhere else, so that no extension goes beyond it.
    """

    def __init__(self, ids: np.ndarray):
        self.rows = len(ids) // MODULUS + 1
        # Numbers of their own fill the last blocks.
        fill = (self.rows + 1) * MODULUS - len(ids)
        self.ids = np.concatenate([ids, ids.max(initial=0) + 1 + np.arange(fill)])
        at = (np.array(COVER)[:, None] + np.arange(self.rows) * MODULUS).ravel()
        levels = [self._blocks(at)]
        row = np.tile(np.arange(self.rows), len(COVER))
        while levels[-1].max() + 1 < len(at):
            size = 1 << (len(levels) - 1)
            later = np.zeros(len(at), dtype=np.int64)
            inside = np.flatnonzero(row + size < self.rows)
            later[inside] = levels[-1][inside + size] + 1
            levels.append(np.unique(levels[-1] * (len(at) + 1) + later, return_inverse=True)[1])
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        a, b = order[:-1], order[1:]
        common = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(levels))):
            # Equal blocks end before the fill, so neither leaves its row.
            x, y = np.minimum(a + common, len(at) - 1), np.minimum(b + common, len(at) - 1)
            common += (levels[k][x] == levels[k][y]).astype(np.int64) << k
        self.least = [common.astype(np.int32)]
        while 2 << len(self.least) - 1 <= len(common):
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """A number for the block of 31 words at each place; equal where the words are."""
        seed = 0
        while True:
            seed += 1
            salted = mix(self.ids.astype(np.uint64) + np.uint64(seed << 40))
            key = np.zeros(len(at), dtype=np.uint64)
            for k in range(MODULUS):
                key = key * np.uint64(0x9E3779B97F4A7C15) + salted[at + k]
            _, first, rank = np.unique(key, return_index=True, return_inverse=True)
            other = at[first[rank]]
            if all((self.ids[at + k] == self.ids[other + k]).all() for k in range(MODULUS)):
                return rank

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        first, place = cover_of()
        delta = (first[(j - i) % MODULUS] - i) % MODULUS
        out = equal_ahead(self.ids, i, j, delta)
        live = np.flatnonzero(out == delta)
        if not len(live):
            return out
        p, q = i[live] + delta[live], j[live] + delta[live]
        x, y = (self.rank[place[s % MODULUS] * self.rows + s // MODULUS] for s in (p, q))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp(high - low)[1] - 1
        common = np.zeros(len(live), dtype=np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            common[own] = np.minimum(self.least[k][low[own]], self.least[k][high[own] - (1 << k)])
        common *= MODULUS
        out[live] += common + equal_ahead(self.ids, p + common, q + common, MODULUS)
        return out


def grid(begin: np.ndarray, size: np.ndarray):
    """The pairs (i, i + q) of the harmonic grids of texts that begin at ``begin``: (text, i, q), in parts."""
    periods = size // LEAST_PERIODS
    text = np.repeat(np.arange(len(size)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (size[text] - q - 1) // (STEP * q) + 1
    total = np.cumsum(points)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS, "right")))
        n = points[first:last]
        own = np.repeat(np.arange(first, last), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield text[own], begin[text[own]] + nth * STEP * q[own], q[own]
        first = last


def _apart(ids: np.ndarray, cuts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbered words of the chosen texts, with a number of its own before, between and after them; begins, sizes."""
    size = np.diff(cuts)[chosen]
    begin = np.cumsum(size + 1) - size
    out = np.arange(int((size + 1).sum()) + 1, dtype=np.int64) + ids.max(initial=0) + 1
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin, size) + at] = ids[np.repeat(cuts[:-1][chosen], size) + at]
    return out, begin, size


def runs_of(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of numbered words (texts between ``cuts``): text, start in the text, length, period; in that order."""
    row, begin, size = _apart(ids, cuts, np.arange(len(cuts) - 1))
    settled, left = [], []
    for text, i, q in grid(begin, size):
        same = np.flatnonzero(row[i] == row[i + q])
        text, i, q = text[same], i[same], q[same]
        ahead, back = equal_ahead(row, i, i + q, NEAR), equal_ahead(row, i, i + q, NEAR, True)
        more = (ahead == NEAR) | (back == NEAR)
        place = i - begin[text]
        settled.append(np.stack([text, place - back, place + q + ahead, q])[:, ~more])
        left.append(np.stack([text, place, q])[:, more])
    left = np.concatenate(left, axis=1) if left else np.zeros((3, 0), dtype=np.int64)
    if left.shape[1]:
        chosen, text = np.unique(left[0], return_inverse=True)
        row, begin, _ = _apart(ids, cuts, chosen)
        i, q = begin[text] + left[1], left[2]
        ahead = Extensions(row)(i, i + q)
        back = Extensions(row[::-1].copy())(len(row) - i, len(row) - i - q)
        settled.append(np.stack([left[0], left[1] - back, left[1] + q + ahead, q]))
    found = np.concatenate(settled, axis=1) if settled else np.zeros((4, 0), dtype=np.int64)
    text, start, end, q = found[:, found[2] - found[1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * found[3])]
    order = np.lexsort((q, end, start, text))
    text, start, end, q = text[order], start[order], end[order], q[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    text, start, end, q = text[new], start[new], end[new], q[new]
    order = np.lexsort((q, start, text))
    return text[order], start[order], (end - start)[order], q[order]


def _collapsed(found: Slice, own: pa.Array, names: list[str]) -> pa.RecordBatch:
    rows = len(found.cuts) - 1
    text, start, length, period = runs_of(dense_ids(found), found.cuts)
    # Words in a run after its first period.
    change = np.zeros(len(found.starts) + 1, dtype=np.int64)
    place = found.cuts[text] + start
    np.add.at(change, place + period, 1)
    np.add.at(change, place + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    bounds = np.searchsorted(text, np.arange(rows + 1))
    parts = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), parts)
    columns = [own, pa.array(np.diff(found.cuts)), runs, joined_words(found, kept)]
    return pa.RecordBatch.from_arrays(columns, names)


def without_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rewrite: Callable[[Slice, pa.Array], Slice] | None = None,
) -> DataFrame:
    """id, n_words, runs (start, length and period, by start and period) and collapsed: the words, each run cut to one period.

    ``rewrite`` may put other words of a slice in the place of its words; it gets the ids of the slice's texts too.
    """
    refuse_names(id_column, "n_words", "runs", "collapsed", "text")
    names = [id_column, "n_words", "runs", "collapsed"]

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in slices(batch.column(1), WHITE):
                own = batch.column(0).slice(found.first, len(found.cuts) - 1)
                yield _collapsed(rewrite(found, own) if rewrite else found, own, names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(id_column, F.col(text_column).alias("text")).mapInArrow(collapse, schema)


def planted(found: Slice, ids: pa.Array) -> Slice:
    """In one text of ten, by the checksum of its id, words repeat from some word on. A null id plants nothing."""
    place = np.arange(len(found.starts))
    for i, name in enumerate(ids.to_pylist()):
        begin, end = found.cuts[i], found.cuts[i + 1]
        h = 1 if name is None else zlib.crc32(str(name).encode())
        if h % 10 == 0 and end > begin:
            n, g = int(end - begin), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            place[begin + a : end] = begin + a + np.arange(n - a) % p
    return replace(found, starts=found.starts[place], ends=found.ends[place])


@register("op12_periodic_runs")
def op12(spark, sf_dir):
    found = without_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    longer = "r.length * b.period > b.length * r.period or r.length * b.period = b.length * r.period and (r.start < b.start or r.start = b.start and r.period < b.period)"
    best = f"aggregate(runs, runs[0], (b, r) -> if({longer}, r, b))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("*", f"if(size(runs) > 0, {best}, null) best").selectExpr(
        "doc_id",
        "cast(size(runs) as bigint) n_runs",
        "best.start",
        "best.length",
        "best.period",
        "1000 * best.length div best.period exponent_milli",
        f"sha2({lines}, 256) runs_sha256",
        "sha2(collapsed, 256) collapsed_sha256",
    )
