"""Token ids of many texts by a byte-level BPE file, equal to the library's.

Three things make it fast and keep it exact:

* Pre-tokens are cut by array operations over the code points of a batch, by the rules of the
  byte-level pattern. Texts that hold an added token's string, or a character on which versions of
  Unicode may differ, go to the library whole.
* ``proven_whole`` tells, once for a file, which vocabulary entries encode alone as one token: it
  merges each by the file's merges. A pre-token that is such an entry is that token.
* Every other distinct pre-token is merged once and remembered. Where all entries are proven whole,
  merging by rank of the joined string gives what the merge list gives: an adjacent pair whose join is
  an entry, but not by a merge of that very pair, would be met when that entry is merged alone too,
  which would then not end as one token. Else the library merges.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np

from .words import BATCH_CHARS, LETTER, SPACE, UNSURE, batches, classes, code_points, run_hashes

# Distinct pre-tokens remembered by a worker before it starts afresh.
REMEMBERED = 1_000_000

# The pattern of byte-level pre-tokens (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def merged(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merge of least rank, leftmost first, until none applies."""
    while len(symbols) > 1:
        pairs = [(rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
        if not pairs:
            break
        _, i = min(pairs)
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]
    return symbols


@functools.cache
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@functools.cache
def proven_whole(path: str) -> frozenset[int]:
    """Ids of the vocabulary entries that encode alone as one token."""
    model = _file(path)["model"]
    rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
    added = {t["id"] for t in _file(path)["added_tokens"]}
    return frozenset(i for s, i in model["vocab"].items() if i not in added and merged(list(s), rank) == [s])


def _readable(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


class Tokens:
    """The encoder of one file; ``not_whole`` are the ids that ``proven_whole`` left out."""

    def __init__(self, path: str, not_whole: frozenset[int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        found = _file(path)
        model, cutter = found["model"], found.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in found["added_tokens"]]
        added = {t["id"] for t in found["added_tokens"]}
        byte = byte_of()
        self.plain = (
            model["type"] == "BPE"
            and not found.get("normalizer")
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        self.whole, self.merge, self.line_end = {}, None, None
        self._forget()
        if self.plain:
            ranks = {bytes(byte[c] for c in s): i for s, i in model["vocab"].items() if i not in added}
            self.whole = {b.decode(): i for b, i in ranks.items() if i not in not_whole and _readable(b)}
            by_rank = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            ids = [model["vocab"]["".join(m)] for m in by_rank]
            if not not_whole and ids == sorted(ids):
                import tiktoken

                self.merge = tiktoken.Encoding(
                    "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
                ).encode_ordinary
                self.line_end = ranks[b"\n"]

    def _forget(self) -> None:
        """Hash, place and number of ids of the pre-tokens met; one entry that no hash equals starts the arrays."""
        self.keys = np.array([2**64 - 1], dtype=np.uint64)
        self.begin, self.size = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype="<u4")

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens in a row, and how many each has."""
        sizes = np.ones(len(pieces), dtype=np.int64)
        ids = [self.whole.get(p) for p in pieces]
        rest = [i for i, found in enumerate(ids) if found is None]
        if not self.merge:
            made = [self._by_library(pieces[i]) for i in rest]
        else:
            # A line end between pre-tokens without white space is a token of its own: one call for all.
            black = [i for i in rest if not pieces[i].isspace()]
            row = np.array(self.merge("\n".join(pieces[i] for i in black)), dtype="<u4")
            cuts = np.flatnonzero(row == self.line_end)
            parts = np.split(row, cuts)
            by_place = {i: part[k > 0 :] for k, (i, part) in enumerate(zip(black, parts))}
            made = [by_place[i] if i in by_place else np.array(self.merge(pieces[i]), dtype="<u4") for i in rest]
        sizes[rest] = [len(m) for m in made]
        flat = np.zeros(sizes.sum(), dtype="<u4")
        direct = np.ones(len(pieces), dtype=bool)
        direct[rest] = False
        begin = np.cumsum(sizes) - sizes
        flat[begin[direct]] = [found for found in ids if found is not None]
        if rest:
            flat[np.repeat(~direct, sizes)] = np.concatenate(made)
        return flat, sizes

    def _by_library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts in a row, and their bounds."""
        points, bounds = code_points(texts)
        starts = pre_tokens(points, bounds)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        hashes = run_hashes(points, starts, np.append(starts[1:], len(points)))
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] != keys)
        if len(new):
            joined, ends = "".join(texts), np.append(starts[1:], len(points))
            pieces = [joined[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            flat, sizes = self._merged(pieces)
            at = place[new]
            self.begin = np.insert(self.begin, at, len(self.flat) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, at, sizes)
            self.keys = np.insert(self.keys, at, keys[new])
            self.flat = np.concatenate([self.flat, flat])
            place = np.searchsorted(self.keys, keys)
        size = self.size[place][which]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.begin[place][which] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, bounds)]

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By batch: index of the first text, all ids in a row, bounds by text."""
        unsure = classes() == UNSURE
        for first, batch in batches(texts):
            if len(batch) == 1 and len(batch[0]) > BATCH_CHARS and self.plain and not self._odd(batch[0], unsure):
                ids = np.concatenate([self._batch([p])[0] for p in safe_pieces(batch[0])])
                yield first, ids, np.array([0, len(ids)])
                continue
            odd = {i for i, t in enumerate(batch) if not self.plain or self._odd(t, unsure)}
            ids, bounds = self._batch(["" if i in odd else t for i, t in enumerate(batch)])
            if odd:
                parts = [self._by_library(t) if i in odd else ids[bounds[i] : bounds[i + 1]] for i, t in enumerate(batch)]
                ids = np.concatenate(parts)
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            yield first, ids, bounds

    def _odd(self, text: str, unsure: np.ndarray) -> bool:
        if any(a in text for a in self.added):
            return True
        if text.isascii():
            return False
        return bool(unsure[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].any())


@functools.cache
def tokens(path: str, not_whole: frozenset[int] = frozenset()) -> Tokens:
    return Tokens(path, not_whole)


def not_whole(path: str) -> frozenset[int]:
    """Entries that are not proven whole, for the tasks; empty where the file has no byte-level vocabulary."""
    if _file(path)["model"]["type"] != "BPE":
        return frozenset()
    added = {t["id"] for t in _file(path)["added_tokens"]}
    return frozenset(_file(path)["model"]["vocab"].values()) - proven_whole(path) - added


def pre_tokens(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each pre-token of the texts begins; it ends where the next begins."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = classes()[points]
    edge = np.zeros(n + 2, dtype=bool)
    edge[bounds] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # White space before something else in the same text: its last character stands apart,
    # and a blank goes to what follows.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    # Contractions, where an apostrophe begins a pre-token.
    mark = np.flatnonzero((points[:-1] == 39) & start[:-1] & ~edge[1:n] & (kind[1:] == LETTER))
    if len(mark):
        one = points[mark + 1]
        two = np.where(edge[mark + 2] | (mark + 2 >= n), 0, points[np.minimum(mark + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[mark[short | long] + 1] = False
        after = mark[short] + 2
        start[after[after < n]] = True
        after = mark[long] + 3
        start[after[after < n]] = True
    return np.flatnonzero(start)


def safe_pieces(text: str, size: int = BATCH_CHARS) -> Iterator[str]:
    """The text, cut before single blanks between other characters, where a pre-token always begins."""
    begin = 0
    while len(text) - begin > size:
        cut = begin + size
        while cut < len(text) - 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]
