"""Repeated passages of words, by matching statistics over compressed FM-indexes of shards.

A window is 35 consecutive words of a document. A word is removed if a window that covers it starts
anywhere else as well, in the same document or another.

* Shards are made by content, so that a document is streamed past the shards alone that can match it. Every window has
  an anchor: the 10-word gram of least hash in it. Equal windows have equal anchors at equal places. The words of the
  windows around an anchor are a segment of at most 54 words.
* Anchors are counted. Segments whose anchor stands nowhere else cannot match. Equal segments are one, with a
  weight (``kinds``), so a passage that a third of all documents share is a sum. A second pass over the texts fetches the
  words of one segment of each kind.
* A shard is what comes, sorted by anchor, until it has ``SHARD_WORDS`` words; an anchor's segments stay together.
  ``FMIndex`` holds it, and its segments are streamed past it: backward search from a segment's end gives how
  far back the words have a weight of two, and matches of 35 words and more are reported.
* An anchor with more than ``MOST_KINDS`` different segments (a phrase that very many texts go on from in ways
  of their own) would not fit a shard. Such an anchor's windows are a shard each: they are told apart by 128 bits of hash
  and their weights added, which is exact, too, and has no large group.

What reaches the driver are bitmaps of at most 32 MB, which keep anchors and texts that cannot match out of shuffles;
joins settle what they let through.

Defined results: null text counts as empty. Texts below 35 words lose nothing. A text of any length is read whole.
Rows of equal id and equal text are two documents: each repeats the other. Ids may be null. An
empty table gives an empty one. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, may_have, wanted, without
from .bytewords import SPACES, Slice, by_slice, byte_set, cut, dense_ids, gathered_bytes, joined_words, slices
from .common import per_batch, refuse_names, register, staged, table
from .fm_index import FMIndex
from .repeats import window_minima
from .words import mix, prefix_sums, span_hashes

LENGTH = 35
GRAM = 10
OFFSETS = LENGTH - GRAM + 1
PLACE_BITS = 28
PLACE = np.uint64((1 << PLACE_BITS) - 1)
SHARD_WORDS = 1 << 19
MOST_KINDS = 1 << 14

WHITE = byte_set(SPACES)


def anchors(hashes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of texts (words between ``cuts``): text, first word (in the text), words, anchor's and segment's identifier."""
    none = np.zeros(0, dtype=np.int64)
    count = np.maximum(np.diff(cuts) - LENGTH + 1, 0)
    if not count.sum():
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    sums = prefix_sums(hashes)
    at = np.arange(len(hashes) - GRAM + 1)
    grams = span_hashes(sums, at, at + GRAM)
    least = window_minima((grams & ~PLACE) | at.astype(np.uint64), OFFSETS)
    starts = np.arange(count.sum()) + np.repeat(cuts[:-1] - (np.cumsum(count) - count), count)
    text = np.repeat(np.arange(len(count)), count)
    anchor = (least[starts] & PLACE).astype(np.int64)
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    anchor, low, end, text = anchor[first], starts[first], starts[last] + LENGTH, text[first]
    segment = mix(span_hashes(sums, low, end) + (anchor - low).astype(np.uint64))
    return text, low - cuts[text], end - low, grams[anchor], segment


def place_key(k: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(k.view(np.uint64) + mix(low.astype(np.uint64) + np.uint64(1))).view(np.int64)


def _anchors(batch: pa.RecordBatch, s: Slice) -> pa.RecordBatch:
    text, low, _, g, segment = anchors(s.hashes(), s.cuts)
    columns = [g.view(np.int64), segment.view(np.int64), batch.column("k").to_numpy()[s.first + text], low]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["g", "s", "k", "low"])


def _with_anchor(bits: bytes):
    """Segments whose anchor may stand elsewhere."""
    return per_batch(lambda batch: batch.filter(pa.array(wanted(bits, batch.column("g").to_numpy()))))


def _texts(bits: bytes):
    """The words of the segments asked for (and of a few more): their places may be in the bitmap."""

    def run(batch: pa.RecordBatch, s: Slice) -> pa.RecordBatch:
        text, low, size, _, _ = anchors(s.hashes(), s.cuts)
        k = batch.column("k").to_numpy()[s.first + text]
        mine = np.flatnonzero(wanted(bits, place_key(k, low)))
        begin = s.cuts[text[mine]] + low[mine]
        row, at = gathered_bytes(s.data, s.starts[begin], s.ends[begin + size[mine] - 1])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(mine), [None, pa.py_buffer(at), pa.py_buffer(row)])
        return pa.RecordBatch.from_arrays([pa.array(k[mine]), pa.array(low[mine]), words.cast(pa.binary())], ["k", "low", "words"])

    return run


COVERS = "g long, s long, x long, y long"


def _numbered(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers from 1 on of the words of segments, a 0 after each; where each begins and ends."""
    found = cut(0, np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum([0, *map(len, words)]), WHITE)
    ids = np.zeros(len(found.starts) + len(words), dtype=np.int64)
    ids[np.arange(len(found.starts)) + found.owners()] = dense_ids(found) + 1
    segment = np.arange(len(words))
    return ids, found.cuts[:-1] + segment, found.cuts[1:] + segment


def _shard(g: np.ndarray, s: np.ndarray, n: np.ndarray, words: list[bytes]) -> pa.Table:
    ids, starts, ends = _numbered(words)
    index = FMIndex(ids, np.repeat(n, ends - starts + 1))
    own, x, y = index.repeated(ids, starts, ends, LENGTH)
    return pa.table({"g": g[own], "s": s[own], "x": x, "y": y})


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, cut into shards between anchors: what of each segment is repeated."""
    held: list[pa.Table] = []
    size = 0

    def done(whole: pa.Table) -> pa.Table:
        return _shard(*(whole[c].to_numpy() for c in ("g", "s", "n")), whole["words"].to_pylist())

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows * (LENGTH + OFFSETS)
        if size >= SHARD_WORDS:
            whole = pa.concat_tables(held)
            g = whole["g"].to_numpy()
            # The last anchor may go on in the next batch.
            last = int(np.flatnonzero(g != g[-1])[-1]) + 1 if (g != g[-1]).any() else 0
            if last:
                yield from done(whole.slice(0, last)).to_batches()
            held = [whole.slice(last)]
            size = held[0].num_rows * (LENGTH + OFFSETS)
    if held:
        yield from done(pa.concat_tables(held)).to_batches()


def _windows(batch: pa.RecordBatch) -> pa.Table:
    """All windows of segments, by two hashes."""
    words = batch.column("words").to_pylist()
    found = cut(0, np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum([0, *map(len, words)]), WHITE)
    count = np.diff(found.cuts) - LENGTH + 1
    own = np.repeat(np.arange(len(words)), count)
    x = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    at = found.cuts[own] + x
    keys = [span_hashes(prefix_sums(found.hashes(seed)), at, at + LENGTH).view(np.int64) for seed in (1, 2)]
    columns = {c: batch.column(c).to_numpy()[own] for c in ("g", "s", "n")}
    return pa.table({"h1": keys[0], "h2": keys[1], **columns, "x": x})


def repeated_words(keyed: DataFrame) -> DataFrame:
    """(k, start, end): words of the text of key k that lie in a repeated window; ranges may overlap."""
    rows = staged(keyed.mapInArrow(by_slice(_anchors, WHITE), "g long, s long, k long, low long"), "anchors")
    seen = staged(rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "seen")
    rows = staged(rows.mapInArrow(_with_anchor(bitmap(seen)), rows.schema), "segments")
    kinds = rows.groupBy("g", "s").agg(F.count("*").alias("n"), F.min_by("low", "k").alias("low"), F.min("k").alias("k"))
    kinds = staged(kinds, "kinds")
    met = kinds.groupBy("g").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    met = staged(met.where("all > 1").select("g", (F.col("kinds") > MOST_KINDS).alias("many")), "met")
    asked = staged(kinds.join(met, "g"), "asked")

    places = bitmap(asked.select("k", "low"), key=lambda batch: place_key(batch.column(0).to_numpy(), batch.column(1).to_numpy()))
    words = keyed.mapInArrow(by_slice(_texts(places), WHITE), "k long, low long, words binary")
    words = staged(asked.join(words, ["k", "low"]).select("g", "s", "n", "many", "words"), "texts")
    few = words.where("not many").select("g", "s", "n", "words")
    covers = few.repartition("g").sortWithinPartitions("g").mapInArrow(_searched, COVERS)
    many = words.where("many")
    if not many.isEmpty():
        windows = many.mapInArrow(per_batch(_windows), "h1 long, h2 long, g long, s long, n long, x long")
        windows = staged(windows, "windows")
        twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("all")).where("all > 1").select("h1", "h2")
        more = windows.join(twice, ["h1", "h2"], "left_semi")
        covers = covers.unionByName(more.select("g", "s", "x", (F.col("x") + LENGTH).alias("y")))
    covers = staged(covers, "covers")
    found = rows.join(covers, ["g", "s"])
    return found.select("k", (F.col("low") + F.col("x")).alias("start"), (F.col("low") + F.col("y")).alias("end"))


def _cut(id_column: str, bits: bytes | None = None):
    """Texts and their ranges to what is kept of them; with ``bits``, texts whose key is not in there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if bits is None else without(bits, batches):
            ranges = batch.column("ranges") if "ranges" in batch.schema.names else None
            for s in slices(batch.column("text"), WHITE):
                rows = len(s.cuts) - 1
                kept = np.ones(len(s.starts), dtype=bool)
                if ranges is not None:
                    own = ranges.slice(s.first, rows).to_pylist()
                    change = np.zeros(len(s.starts) + 1, dtype=np.int64)
                    for i, found in enumerate(own):
                        for r in found or ():
                            change[s.cuts[i] + r["start"]] += 1
                            change[s.cuts[i] + r["end"]] -= 1
                    kept = np.cumsum(change[:-1]) == 0
                gone = np.concatenate([[0], np.cumsum(~kept)])[s.cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(id_column).slice(s.first, rows),
                        pa.array(np.diff(s.cuts)),
                        pa.array(np.diff(gone)),
                        joined_words(s, kept),
                    ],
                    [id_column, "n_words", "n_removed", "kept"],
                )

    return run


def without_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, n_removed and kept (the remaining words, joined by one space) of each document."""
    refuse_names(id_column, "n_words", "n_removed", "kept", "text", "ranges", "k")
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(F.col(id_column), F.xxhash64(F.col(id_column), text).alias("k"), text.alias("text"))
    ranges = repeated_words(keyed.select("k", "text")).distinct()
    lists = staged(ranges.groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges")
    schema = f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, n_words long, n_removed long, kept string"
    bits = bitmap(lists.select("k"))
    touched = may_have(keyed, lists, bits).join(lists, "k", "left").select(id_column, "text", "ranges")
    return touched.mapInArrow(_cut(id_column), schema).unionByName(keyed.mapInArrow(_cut(id_column, bits), schema))


@register("op13_repeated_passages")
def op13(spark, sf_dir):
    found = without_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
