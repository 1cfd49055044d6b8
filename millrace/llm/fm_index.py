"""A compressed FM-index over numbers, asked about many patterns at once by array operations.

The Burrows-Wheeler transform lies in a wavelet tree shaped by a Huffman code, one packed bit row a level, with
counts at every 64 bits: about 1.5 bits for each bit of entropy. Number 0 ends a segment: no match goes across it.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np


def code_lengths(weights: np.ndarray) -> np.ndarray:
    """Lengths of a Huffman code; each at least 1."""
    if len(weights) == 1:
        return np.ones(1, dtype=np.int64)
    heap = [(int(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    above = [0] * (2 * len(weights) - 1)
    for made in range(len(weights), 2 * len(weights) - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        above[i] = above[j] = made
        heapq.heappush(heap, (a + b, made))
    depth = [0] * len(above)
    for i in range(len(above) - 2, -1, -1):
        depth[i] = depth[above[i]] + 1
    return np.array(depth[: len(weights)], dtype=np.int64)


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes of these lengths, aligned to the left of the longest."""
    most = int(lengths.max())
    order = np.argsort(lengths, kind="stable")
    size = np.uint64(1) << (most - lengths[order]).astype(np.uint64)
    out = np.zeros(len(lengths), dtype=np.uint64)
    out[order] = np.cumsum(size) - size
    return out


class WaveletTree:
    """How often a number stands in a prefix of the row."""

    def __init__(self, row: np.ndarray, kinds: int):
        self.lengths = code_lengths(np.bincount(row, minlength=kinds))
        self.codes = codes = canonical(self.lengths)
        self.depth = int(self.lengths.max())
        self.levels, self.start, self.base = [], [], []
        code, length = codes[row], self.lengths[row]
        for level in range(self.depth):
            ahead = np.uint64(self.depth - level)
            # Nodes of a level lie by prefix; the order within a node is that of the row.
            prefix = code >> ahead
            order = np.argsort(prefix, kind="stable")
            code, length, prefix = code[order], length[order], prefix[order]
            bits = ((code >> (ahead - np.uint64(1))) & np.uint64(1)).astype(np.uint8)
            packed = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
            packed[: -(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
            words = packed.view(np.uint64)
            before = np.zeros(len(words), dtype=np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before))
            start = np.searchsorted(prefix, codes >> ahead)
            self.start.append(start.astype(np.int32))
            self.base.append(self._ones(level, start).astype(np.int32))
            more = length > level + 1
            code, length = code[more], length[more]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        words, before = self.levels[level]
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before its places: ``at`` has a row of places for each question."""
        # Long codes first, so that the symbols still open at a level are the first ones.
        order = np.argsort(-self.lengths[symbol], kind="stable")
        symbol, out = symbol[order], at[:, order].astype(np.int32)
        code, length = self.codes[symbol], -self.lengths[symbol]
        for level in range(self.depth):
            live = int(np.searchsorted(length, -level))
            if not live:
                break
            own, place = symbol[:live], out[:, :live]
            ones = self._ones(level, self.start[level][own] + place) - self.base[level][own]
            bit = (code[:live] >> np.uint64(self.depth - 1 - level)) & np.uint64(1) > 0
            out[:, :live] = np.where(bit, ones, place - ones)
        found = np.empty(at.shape, dtype=np.int64)
        found[:, order] = out
        return found


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Places by their suffixes, by doubling; each 0 is a number of its own, so that no suffix is read beyond it."""
    ends = ids == 0
    rank = np.where(ends, np.cumsum(ends) - 1, ids + ends.sum())
    rank = np.unique(rank, return_inverse=True)[1]
    size = 1
    while rank.max(initial=0) + 1 < len(ids):
        later = np.zeros(len(ids), dtype=np.int64)
        later[:-size] = rank[size:] + 1
        rank = np.unique(rank * (len(ids) + 1) + later, return_inverse=True)[1]
        size *= 2
    out = np.zeros(len(ids), dtype=np.int64)
    out[rank] = np.arange(len(ids))
    return out


class FMIndex:
    """``ids``: numbers from 1 on, with a 0 after each segment. ``weights``: how often each place counts."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray | None = None):
        order = suffix_order(ids)
        kinds = int(ids.max(initial=0)) + 1
        self.size = len(ids)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=kinds))])
        self.tree = WaveletTree(ids[order - 1], kinds)
        self.weight = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(np.ones(len(ids), dtype=np.int64) if weights is None else weights[order], out=self.weight[1:])

    def backward(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with ``symbol`` and go on as one of those between ``low`` and ``high``."""
        low, high = self.below[symbol] + self.tree.rank(symbol, np.stack([low, high]))
        return low, high

    def match_lengths(self, stream: np.ndarray, ends: np.ndarray, most: np.ndarray, least: int) -> np.ndarray:
        """Matching statistics: of the words of ``stream`` before each end, how many the index holds in a row
        with a weight of ``least`` or more; ``most`` words at most."""
        out = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.size)
        live = np.flatnonzero(most > 0)
        step = 0
        while len(live):
            step += 1
            symbol = stream[ends[live] - step]
            a, b = self.backward(symbol, low[live], high[live]) if step > 1 else (self.below[symbol], self.below[symbol + 1])
            good = self.weight[b] - self.weight[a] >= least
            live, a, b = live[good], a[good], b[good]
            low[live], high[live], out[live] = a, b, step
            live = live[most[live] > step]
        return out

    def repeated(self, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each segment of ``stream`` the matches of ``length`` words and more: segment, start and end in it.

        Together they hold every such match. What is left of a segment is searched from both ends in turn: a match
        that ends at the right end is reported as long as it is, and one that should begin at the left end and breaks off at
        some word shows that none begins before that word.
        """
        found = []
        own, low, high = np.arange(len(starts)), starts.copy(), ends.copy()

        def report(hit: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
            found.append(np.stack([own[hit], (begin - starts[own])[hit], (end - starts[own])[hit]]))

        for turn in itertools.cycle((True, False)):
            more = high - low >= length
            own, low, high = own[more], low[more], high[more]
            if not len(own):
                break
            if turn:
                size = self.match_lengths(stream, high, high - low, least)
                hit = size >= length
                report(hit, high - size, high)
                high = np.where(hit, high - size + length - 1, high - 1)
            else:
                size = self.match_lengths(stream, low + length, np.full(len(low), length), least)
                hit = size == length
                report(hit, low, low + length)
                low = np.where(hit, low + 1, low + length - size)
        return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, dtype=np.int64),) * 3
