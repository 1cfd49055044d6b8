"""Stupid-backoff language model scores of documents, with n-gram counts of the corpus itself.

    S(w | h) = c(h w) / c(h)          if h w occurs at least MIN_COUNT times,
               ALPHA * S(w | h')      else, with h' the history without its first word,
    S(w)     = c(w) / N.

A document's score is the mean of log S over its words. n-grams are of lower-case words and do not cross
documents.

Counts are a table partitioned by n-gram hash, joined to the documents' n-grams and summed by
document. A row for each n-gram of each document would write many times the corpus, so rows are
blocks: a chunk of documents (``CHUNK`` characters) asks each partition of the table for its distinct
n-grams with one packed row; the partition adds up all chunks' counts, and answers each
chunk with one row of totals in the order asked. What is shuffled follows the distinct
n-grams of chunks, and frequent n-grams cost one entry a chunk, whatever their number.
The number of partitions follows the corpus, so that a partition's n-grams fit a task.

Hashes have 56 bits: among 10**11 n-grams, one in a million shares its hash with another.

Defined results: null text counts as empty. A text without words has 0 words and a null score. Ids may
be null or repeat; repeated documents count as often as they occur. An empty table gives an empty
one. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, staged, table, texts_of
from .words import mix, word_hashes

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2
CHUNK = 8_000_000
# n-grams of a partition of the counts, before those of several chunks are added up.
PER_PARTITION = 4_000_000
HASH_BITS = 56


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def sorted_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partitions are ranges of hashes, so that sorted hashes lie partition by partition."""
    return ((hashes >> np.uint64(HASH_BITS - 32)) * np.uint64(parts)) >> np.uint64(32)


def n_grams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length, the hash of the n-gram that ends at each word (0 where the text is too short), and bounds."""
    found, bounds, total = [], [np.zeros(1, dtype=np.int64)], 0
    for _, hashes, at in word_hashes(texts):
        found.append(hashes)
        bounds.append(at[1:] + total)
        total += len(hashes)
    words = np.concatenate([np.zeros(0, dtype=np.uint64), *found])
    bounds = np.concatenate(bounds)
    place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
    out, run = [], np.zeros(len(words), dtype=np.uint64)
    for n in range(1, order + 1):
        # The hash of n words: that of the n - 1 before, and the last.
        before = np.concatenate([np.zeros(1, dtype=np.uint64), run[:-1]]) if len(run) else run
        run = mix(before * np.uint64(0x9E3779B97F4A7C15) + words) if n > 1 else mix(words)
        run = np.where(place >= n - 1, run, 0)
        out.append((run >> np.uint64(64 - HASH_BITS)) + np.where(place >= n - 1, np.uint64(1), np.uint64(0)))
    return out, bounds


def read_chunk(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().stream_reader(data)).read_all()


def _chunks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in chunks: chunk, number of words, and ids and texts as compressed Arrow."""
    task, number = TaskContext.get().partitionId(), 0
    rows, chars = [], 0

    def made() -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema) as writer:
            writer.write_table(whole)
        data = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        words = sum(len(h) for _, h, _ in word_hashes(texts_of(whole.combine_chunks().to_batches()[0])))
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + number]), pa.array([words]), pa.array([data], type=pa.binary())], ["chunk", "words", "data"]
        )

    for batch in found:
        sizes = np.array([len(t) for t in texts_of(batch)])
        first = 0
        for i in range(batch.num_rows):
            chars += sizes[i]
            if chars >= CHUNK:
                rows.append(batch.slice(first, i + 1 - first))
                yield made()
                rows, chars, first, number = [], 0, i + 1, number + 1
        if first < batch.num_rows:
            rows.append(batch.slice(first))
    if rows:
        yield made()


def _asking(order: int, parts: int):
    """Each chunk's distinct n-grams and their counts, a row for each partition."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist()):
                keys, counts = chunk_counts(read_chunk(data), order)
                part = part_of(keys, parts)
                cut = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                some = np.flatnonzero(np.diff(cut))
                # In a few batches, so that a batch of many partitions stays small.
                for at in range(0, len(some), 256):
                    own = some[at : at + 256]
                    asked = [packed(np.diff(keys[cut[p] : cut[p + 1]], prepend=np.uint64(0))) for p in own]
                    times = [packed(counts[cut[p] : cut[p + 1]]) for p in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own.astype(np.int64)),
                            pa.array(np.full(len(own), chunk)),
                            pa.array(asked, type=pa.binary()),
                            pa.array(times, type=pa.binary()),
                        ],
                        ["part", "chunk", "asked", "times"],
                    )

    return run


def chunk_counts(docs: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    grams, _ = n_grams(texts_of(docs.combine_chunks().to_batches()[0]), order)
    keys, counts = np.unique(np.concatenate([g[g > 0] for g in grams]), return_counts=True)
    return keys, counts


def _totals(found: pa.Table) -> pa.Table:
    """Add up the counts of all chunks in a partition, and answer each in the order it asked."""
    asked = [sorted_hashes(a) for a in found["asked"].to_pylist()]
    keys, which = np.unique(np.concatenate(asked), return_inverse=True)
    times = np.concatenate([unpacked(t) for t in found["times"].to_pylist()])
    totals = np.bincount(which, weights=times, minlength=len(keys)).astype(np.uint64)[which]
    ends = np.cumsum([len(a) for a in asked])
    return pa.table(
        {
            "chunk": found["chunk"],
            "part": found["part"],
            "answer": pa.array([packed(t) for t in np.split(totals, ends[:-1])], type=pa.binary()),
        }
    )


def placed(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams, sorted, and where each of all n-grams (by length, then place) stands among them."""
    return np.unique(np.concatenate([g[g > 0] for g in grams]), return_inverse=True)


def log_scores(grams: list[np.ndarray], which: np.ndarray, totals: np.ndarray, n_words: int) -> np.ndarray:
    """log S of each word; ``which`` as ``placed`` gives it, with the total of each distinct n-gram."""
    count, first = [np.zeros(len(g)) for g in grams], 0
    for c, g in zip(count, grams):
        there = g > 0
        last = first + np.count_nonzero(there)
        c[there] = totals[which[first:last]]
        first = last
    score = np.log(count[0] / n_words)
    for n in range(1, len(grams)):
        history = np.concatenate([[1.0], count[n - 1][:-1]])
        found = count[n] >= MIN_COUNT
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.log(count[n] / history)
        # Where the text is too short for a history of this length, there is nothing to back off from.
        score = np.where(found, direct, np.where(grams[n] > 0, np.log(ALPHA) + score, score))
    return score


def backoff_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER) -> DataFrame:
    """id, n_words, log_score (sum of log S) and score (its mean) for each document."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    chunks = staged(source.mapInArrow(_chunks, "chunk long, words long, data binary"), "chunks")
    n_words = chunks.agg(F.sum("words")).first()[0] or 0
    parts = max(12, -(-n_words * order // PER_PARTITION))
    asked = chunks.mapInArrow(_asking(order, parts), "part long, chunk long, asked binary, times binary")
    answers = asked.groupBy("part").applyInArrow(_totals, "chunk long, part long, answer binary")
    schema = f"`{id_column}` {kind}, n_words long, log_score double"

    def score(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        docs = pa.concat_tables([read_chunk(d) for d in chunk["data"].to_pylist()])
        grams, bounds = n_grams(texts_of(docs.combine_chunks().to_batches()[0]), order)
        # One sort gives the n-grams asked for and their places; looking each up would cost twice that.
        keys, which = placed(grams)
        answer = answer.sort_by("part")
        totals = np.concatenate([np.zeros(0, dtype=np.uint64), *[unpacked(a) for a in answer["answer"].to_pylist()]])
        if len(totals) != len(keys):
            raise ValueError("counts and n-grams of a chunk differ")
        each = log_scores(grams, which, totals, n_words) if len(keys) else np.zeros(0)
        sums = np.concatenate([[0.0], np.cumsum(each)])
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        return pa.table({id_column: docs[id_column], "n_words": pa.array(np.diff(bounds)), "log_score": pa.array(total)})

    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    return scored.withColumn("score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


@register("op3_backoff")
def op3(spark, sf_dir):
    return backoff_scores(table(spark, sf_dir, "documents"))
