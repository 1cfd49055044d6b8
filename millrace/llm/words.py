"""Words, shingles and token spans of many texts at once, as numpy arrays.

A batch of texts becomes one array of code points. Runs of letters and digits, hashes of spans and
hashes of consecutive words are then array operations, so that a task spends a few dozen
nanoseconds a character and holds a bounded batch only.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

OTHER, LETTER, NUMBER, SPACE, UNSURE = 0, 1, 2, 3, 4

# Characters handled at once; a longer text is cut between words.
BATCH_CHARS = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
# White space as regular expressions have it.
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits: a bijection, so that distinct stays distinct."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point. UNSURE: versions of Unicode may differ on it."""
    old = unicodedata.ucd_3_2_0.category
    table = np.full(sys.maxunicode + 1, UNSURE, dtype=np.uint8)
    for point in range(0x20000):
        kind = unicodedata.category(chr(point))
        if kind[0] == old(chr(point))[0] and kind != "Cn":
            table[point] = {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)
    table[[ord(c) for c in WHITE]] = SPACE
    return table


@functools.cache
def word_classes() -> np.ndarray:
    """True where a code point belongs to a word; anything unsure does."""
    table = classes()
    return (table == LETTER) | (table == NUMBER) | (table == UNSURE)


@functools.cache
def lower_case() -> np.ndarray:
    """The lower-case form of each code point, where that is one code point."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint64)
    for point in range(0x20000):
        form = chr(point).lower()
        if len(form) == 1:
            table[point] = ord(form)
    return table


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    ones = np.ones(size + 1, dtype=np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = BASE, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(size).bit_length()))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial in BASE of the first i values, modulo 2**64."""
    up, _ = powers(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) by its content and length, wherever it stands.

    For spans of at most some hundred values, which may overlap: from 1,024 values on there are different spans that
    a polynomial modulo 2**64 never tells apart, whatever its base.
    """
    _, down = powers(len(sums))
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of values below 2**21, of any length; spans that do not overlap cost their length.

    Each value is mixed with its place in the span before the sum, so that no rule of the text makes sums meet.
    """
    sizes = ends - starts
    at = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=at[1:])
    row = np.arange(at[-1])
    place = row - np.repeat(at[:-1], sizes)
    found = values[row + np.repeat(starts - at[:-1], sizes)].astype(np.uint64)
    sums = np.zeros(len(row) + 1, dtype=np.uint64)
    np.cumsum(mix(found + (place.astype(np.uint64) + np.uint64(1) << np.uint64(21))), out=sums[1:])
    return mix((sums[at[1:]] - sums[at[:-1]]) ^ np.uint64(0xD6E8FEB86659FD93))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, and where each begins (one entry more than texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return points, bounds


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a bound: starts and ends."""
    flags = np.zeros(len(inside) + 1, dtype=bool)
    flags[:-1] = inside
    before = np.zeros(len(inside) + 1, dtype=bool)
    before[1:] = inside
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(flags & (~before | edge))
    ends = np.flatnonzero(before & (~flags | edge))
    return starts, ends


def pieces(text: str, size: int = BATCH_CHARS) -> Iterator[str]:
    """The text, cut between words into pieces of about ``size`` characters."""
    inside = word_classes()
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and inside[ord(text[cut])] and inside[ord(text[cut - 1])]:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def batches(texts: list[str], size: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Slices of the list of about ``size`` characters and at most 4,000 texts: first index, texts."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        if i > first and (chars + len(text) > size or i - first == 4000):
            yield first, texts[first:i]
            first, chars = i, 0
        chars += len(text)
    if first < len(texts):
        yield first, texts[first:]


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of one batch: hash of the lower-case form, start, end in the joined texts, and the number of words before each text."""
    points, bounds = code_points(texts)
    starts, ends = runs(word_classes()[points], bounds)
    hashes = run_hashes(lower_case()[points], starts, ends)
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of the lower-case words of whole texts, by batch: index of the first text, hashes, bounds by text."""
    for first, batch in batches(texts):
        if len(batch) == 1 and len(batch[0]) > BATCH_CHARS:
            hashes = np.concatenate([words([p])[0] for p in pieces(batch[0])])
            yield first, hashes, np.array([0, len(hashes)])
        else:
            hashes, _, _, bounds = words(batch)
            yield first, hashes, bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words within a text, and the bounds by text.

    A text of fewer words, if it has any, gives one shingle: all its words.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(made, out=out[1:])
    starts = np.repeat(bounds[:-1] - out[:-1], made) + np.arange(out[-1])
    ends = np.minimum(starts + width, np.repeat(bounds[1:], made))
    found = mix((ends - starts).astype(np.uint64))
    for i in range(width):
        mine = starts + i < ends
        more = mix(found * BASE + hashes[np.where(mine, starts + i, 0)]) if len(hashes) else found
        found = more if mine.all() else np.where(mine, more, found)
    return found, out
