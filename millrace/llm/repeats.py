"""Repeated byte strings by bucket-pointer refinement over chosen suffixes.

A byte is removed if a string of 400 bytes that covers it starts anywhere else as well, in the same text
or another. Every 400-byte string (window) has an anchor: the start of the q-gram (64 bytes) of least
hash in it. Equal windows have their anchors at the same place, so only the suffixes at anchors, about one in
170 bytes, need sorting into buckets:

* The initial bucket of an anchor is the identifier of its q-gram. A bucket of one is done: none of
  its windows is repeated.
* A string longer than a q-gram has the identifier that its q-grams' identifiers at later offsets
  give. For a range of windows (by their offset to the anchor) the *core* is what all of them share,
  and the *span* all that they cover. A bucket by core of one member is done: no window of the range is
  repeated there. Members of a bucket by span of two or more are done too: all of their windows are.
* Other buckets are refined: the range is cut into eight, and the identifiers of the new cores and
  spans are put together from those of the q-grams. Of equal spans one member goes on, for the others to meet.
  After three rounds a range is one window, where core and span are the same.

Ranges: 337 offsets, then 43, 6 and 1. Identifiers are 64 bits, and each bucket joins two or three of
them (q-gram, core, span). Buckets are counted, never gathered, so a passage that a third of all
documents share is a sum. The bytes around an anchor (737 at most) are fetched for those
anchors only whose bucket is not settled by the first round. Texts are shuffled only where a bitmap of
fixed size tells that they may have such anchors, or bytes to remove.

Defined results: null text counts as empty. Texts below 400 bytes lose nothing. A text of any length is
cut into blocks that overlap. Rows of equal id and equal text are two documents: each repeats the
other. Ids may be null. An empty table gives an empty one. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, may_have, without
from .bytewords import buffers
from .common import per_batch, refuse_names, register, staged, table
from .words import mix, prefix_sums, span_hashes

LENGTH = 400
GRAM = 64
OFFSETS = LENGTH - GRAM + 1
RANGES = (43, 6, 1)
POSITION_BITS = 20
BLOCK = 1 << POSITION_BITS
POSITION = np.uint64(BLOCK - 1)
SEED = np.uint64(0x9E3779B97F4A7C15)


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Identifier of the q-gram at each position."""
    at = np.arange(max(len(data) - GRAM + 1, 0))
    return span_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1)), at, at + GRAM)


def string_ids(grams: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Identifier of each string [start, end), from the identifiers at later offsets within it."""
    out = mix(salt.astype(np.uint64) * SEED + (ends - starts).astype(np.uint64))
    steps = -(-(ends - starts) // GRAM)
    for step in range(int(steps.max()) if len(steps) else 0):
        more = np.flatnonzero(steps > step)
        at = np.minimum(starts[more] + step * GRAM, ends[more] - GRAM)
        out[more] = mix(out[more] * SEED + grams[at])
    return out


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each run of ``width``."""
    size, least = 1, keys
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def blocks(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int]], list[bytes]]]:
    """Texts (or overlapping parts of long ones) of up to ``BLOCK`` bytes: (text, offset) and the parts."""
    names, parts, size = [], [], 0
    for i, text in enumerate(texts):
        step = BLOCK - LENGTH + 1
        for offset in range(0, max(len(text) - LENGTH + 1, 0), step):
            part = text[offset : offset + BLOCK]
            if size + len(part) > BLOCK and parts:
                yield names, parts
                names, parts, size = [], [], 0
            names.append((i, offset))
            parts.append(part)
            size += len(part)
    if parts:
        yield names, parts


def anchors(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Part, anchor, first and last window start (within the part), q-gram and span identifier."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    bounds = np.cumsum([0, *map(len, parts)])
    grams = gram_ids(data)
    keys = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
    least = window_minima(keys, OFFSETS)
    count = np.diff(bounds) - LENGTH + 1
    ends = np.cumsum(count)
    starts = np.arange(ends[-1]) + np.repeat(bounds[:-1] - (ends - count), count)
    at = (least[starts] & POSITION).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    anchor, low, high = at[first], starts[first], starts[last]
    spans = string_ids(grams, low, high + LENGTH, (anchor - low) * 512 + (anchor - high))
    part = np.searchsorted(bounds, anchor, "right") - 1
    shift = bounds[part]
    return part, anchor - shift, low - shift, high - shift, grams[anchor], spans


# Bytes of text whose rows a task makes at once.
SLICE = 1 << 22


def encoded(batch: pa.RecordBatch) -> list[memoryview]:
    """The texts' bytes, where they lie in the batch."""
    data, bounds = buffers(batch.column("text"))
    view = memoryview(np.ascontiguousarray(data))
    return [view[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE`` bytes of text."""
    _, bounds = buffers(batch.column("text"))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def _anchors(batch: pa.RecordBatch) -> pa.Table | None:
    keys, made = batch.column("k").to_numpy(), []
    for names, parts in blocks(encoded(batch)):
        part, anchor, low, high, gram, span = anchors(parts)
        row = np.array([n[0] for n in names])[part]
        offset = np.array([n[1] for n in names])[part]
        made.append(
            pa.table(
                {
                    "g": pa.array(gram.view(np.int64)),
                    "span": pa.array(span.view(np.int64)),
                    "k": pa.array(keys[row]),
                    "a": pa.array(anchor + offset),
                    "low": pa.array(low + offset),
                    "high": pa.array(high + offset),
                }
            )
        )
    return pa.concat_tables(made) if made else None


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each anchor asked for."""
    for batch in batches:
        for part in by_size(batch):
            lists = part.column("asked")
            asked = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            columns = {c: asked.field(c) for c in ("uid", "g", "k", "a", "low", "high")}
            texts, low, high = encoded(part), columns["low"].to_numpy(), columns["high"].to_numpy()
            around = [bytes(texts[i][a : b + LENGTH]) for i, a, b in zip(owner.tolist(), low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(around, type=pa.binary())], [*columns, "around"])


def _refine(width: int):
    """Cut each asked range of windows into ranges of ``width``: their cores and spans."""

    def refine(batch: pa.RecordBatch) -> pa.Table | None:
        made = []
        around = batch.column("around").to_pylist()
        numbers = {c: batch.column(c).to_numpy() for c in ("uid", "g", "k", "a", "low", "high")}
        asked = batch.column("asked").to_pylist()
        # As many anchors at once as have about a block of bytes around them.
        for at in range(0, len(around), 1024):
            cut = slice(at, at + 1024)
            data = np.frombuffer(b"".join(around[cut]), dtype=np.uint8)
            shift = np.cumsum([0, *map(len, around[cut])])
            grams = gram_ids(data)
            owner, x, y = [], [], []
            for i, ranges in enumerate(asked[cut]):
                for begin, end in ((r["x"], r["y"]) for r in ranges):
                    for b in range(begin, end, width):
                        owner.append(i)
                        x.append(b)
                        y.append(min(b + width, end))
            owner, x, y = (np.array(v, dtype=np.int64) for v in (owner, x, y))
            own = {c: v[cut][owner] for c, v in numbers.items()}
            # Offsets of the anchor's own windows within the range.
            cx, cy = np.maximum(x, own["a"] - own["high"]), np.minimum(y, own["a"] - own["low"] + 1)
            fit = cx < cy
            owner, x, y, cx, cy = owner[fit], x[fit], y[fit], cx[fit], cy[fit]
            own = {c: v[fit] for c, v in own.items()}
            anchor = shift[owner] + own["a"] - own["low"]
            core = string_ids(grams, anchor - x, anchor - (y - 1) + LENGTH, x * 512 + y)
            span = string_ids(grams, anchor - (cy - 1), anchor - cx + LENGTH, cx * 512 + cy)
            made.append(
                pa.table(
                    {
                        **{c: pa.array(own[c]) for c in ("uid", "g", "k")},
                        "core": pa.array(core.view(np.int64)),
                        "span": pa.array(span.view(np.int64)),
                        "x": pa.array(x),
                        "y": pa.array(y),
                        "start": pa.array(own["a"] - (cy - 1)),
                        "end": pa.array(own["a"] - cx + LENGTH),
                    }
                )
            )
        return pa.concat_tables(made) if made else None

    return per_batch(refine)


REFINED = "uid long, g long, k long, core long, span long, x long, y long, start long, `end` long"


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of buckets by core: (k, start, end) that are covered, and (uid, x, y) to refine."""
    spans = staged(
        rows.groupBy("g", "core", "span").agg(F.count("*").alias("n"), F.min("uid").alias("uid"), F.min("x").alias("x"), F.min("y").alias("y")),
        "spans",
    )
    covered = rows.join(spans.where("n > 1").select("g", "core", "span"), ["g", "core", "span"], "left_semi")
    cores = spans.groupBy("g", "core").agg(F.count("*").alias("spans"), F.min("n").alias("least"))
    cores = staged(cores.where("spans > 1 and least = 1").select("g", "core"), "cores")
    return covered.select("k", "start", "end"), spans.join(cores, ["g", "core"]).select("uid", "x", "y")


def repeated_ranges(keyed: DataFrame) -> DataFrame:
    """(k, start, end): bytes of the text of key k that lie in a repeated string; ranges may overlap."""
    rows = staged(keyed.mapInArrow(per_batch(_anchors), "g long, span long, k long, a long, low long, high long"), "anchors")
    grams = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("span").alias("s0"), F.max("span").alias("s1"))
    grams = staged(grams.where("n > 1").select("g", (F.col("s0") == F.col("s1")).alias("even")), "buckets")
    met = staged(
        rows.join(grams, "g").select("*", F.xxhash64("k", "a", "low").alias("uid")), "met"
    )
    window = [F.col("low").alias("start"), (F.col("high") + LENGTH).alias("end")]
    covered = [met.where("even").select("k", *window)]
    first = met.where("not even").select(
        "uid", "g", "k", F.lit(0).cast("long").alias("core"), "span", F.lit(0).cast("long").alias("x"),
        F.lit(OFFSETS).cast("long").alias("y"), *window,
    )
    found, ask = _settle(first)
    covered.append(found)
    ask = staged(ask, "ask")
    places = (
        met.join(ask.select("uid").distinct(), "uid", "left_semi")
        .dropDuplicates(["uid"])
        .groupBy("k")
        .agg(F.collect_list(F.struct("uid", "g", "k", "a", "low", "high")).alias("asked"))
    )
    places = staged(places, "places")
    texts = may_have(keyed, places.select("k")).join(places, "k").select("text", "asked")
    kind = "uid long, g long, k long, a long, low long, high long, around binary"
    around = staged(texts.mapInArrow(_around, kind).dropDuplicates(["uid"]), "around")
    for width in RANGES:
        asked = ask.groupBy("uid").agg(F.collect_list(F.struct("x", "y")).alias("asked"))
        rows = staged(around.join(asked, "uid").mapInArrow(_refine(width), REFINED), "refined")
        found, ask = _settle(rows)
        covered.append(found)
        ask = staged(ask, "ask")
    out = covered[0]
    for more in covered[1:]:
        out = out.unionByName(more)
    return out.distinct()


def remaining(size: int, ranges: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """The parts of a text of ``size`` bytes outside the ranges, and the number of maximal removed runs."""
    out, done, runs, reach = [], 0, 0, -1
    for start, end in sorted(ranges):
        if start > reach:
            runs += 1
            if start > done:
                out.append((done, start))
        done, reach = max(done, end), max(reach, end)
    if size > done:
        out.append((done, size))
    return out, runs


def _cut(id_column: str, with_kept: bool, bits: bytes | None = None):
    """Texts and their ranges to what is left of them; with ``bits``, texts whose key is not in there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if bits is None else without(bits, batches):
            for part in by_size(batch):
                texts = encoded(part)
                ranges = part.column("ranges").to_pylist() if "ranges" in part.schema.names else [None] * len(texts)
                made = [remaining(len(t), [(r["start"], r["end"]) for r in f or ()]) for t, f in zip(texts, ranges)]
                digests, whole = [], []
                for text, (places, _) in zip(texts, made):
                    digest = hashlib.sha256()
                    for a, b in places:
                        digest.update(text[a:b])
                    digests.append(digest.hexdigest())
                    if with_kept:
                        whole.append(b"".join(text[a:b] for a, b in places))
                size = np.array([len(t) for t in texts])
                left = np.array([sum(b - a for a, b in places) for places, _ in made])
                columns = [part.column(id_column), pa.array(size), pa.array(size - left), pa.array([runs for _, runs in made]), pa.array(digests)]
                names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_kept:
                    columns.append(pa.array(whole, type=pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_kept: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes of each document."""
    refuse_names(id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text", "ranges", "k")
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(F.col(id_column), F.xxhash64(F.col(id_column), text).alias("k"), text.alias("text"))
    ranges = repeated_ranges(keyed.select("k", "text"))
    lists = staged(ranges.groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges")
    schema = f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_kept else ""
    bits = bitmap(lists.select("k"))
    touched = may_have(keyed, lists, bits).join(lists, "k", "left").select(id_column, "text", "ranges")
    whole = keyed.mapInArrow(_cut(id_column, with_kept, bits), schema)
    return touched.mapInArrow(_cut(id_column, with_kept), schema).unionByName(whole)


@register("op10_repeats")
def op10(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"), with_kept=False)
