"""Collocations of two to four words from a weighted de Bruijn graph of four-word grams.

Nodes are runs of three words, and an edge is a run of four: it leads from its first three words to its last
three, weighted by how often it occurs. Only edges are counted; all shorter counts are derived.

* ``vocabulary`` counts words. Those that occur too rarely to be in any candidate end a piece, which
  changes no count of a phrase without them. The most frequent words (``MOST_WORDS``) get short numbers,
  any further ones keep their hash, so that numbers only make rows smaller and leave out nothing.
* ``edges``: rows (w1, w2, w3, w4, n), summed in the task first. A piece's last three words are an edge
  to its end (w4 = 0); a shorter piece is a row of its own. This is the one large shuffle, by node.
* ``flows``: rows come sorted, so a node's flow is the sum of its edges with the one to the end. The flows
  of runs of two words and of one are sums of those in turn, plus the corrections for what stands at a
  piece's end, where no longer run begins with it. Only sums that may reach ``least`` leave the task.
* ``paths``: a node whose whole flow comes by one edge and goes by one is unary. Edges that meet in such
  nodes are compacted into one path by pointer doubling. A run of three words that is a unary node lies in an
  edge of equal weight, so it is no candidate that could stay.

Hashes of words in use are proven distinct (``vocabulary`` compares the words, and takes another seed if
two meet), and sums and scores are exact (decimals). A phrase that one of three words or four holds with
80 % of its count is dropped; the counts of runs within runs make it enough to look at those one word longer.

Defined results: null text counts as empty, null lang as ``und``. A text without a word counts nothing. A
text of any length is read whole. Rows of equal id are documents of their own, and repeated rows count
again. Ties go by the phrase's bytes. An empty table gives an empty one. Further columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import Slice, byte_set, slices, texts_column
from .common import per_batch, register, staged, table
from .words import mix

LEAST = 30
SHARE = 80
TOP = 2000
# Words with a number of their own: eight bytes each go to every worker.
MOST_WORDS = 1 << 22
# Rows that a task holds before it sends their sums.
HELD = 1 << 20

CUTS = byte_set(b".,;:!?\n\x0b\x0c\r")
SEPARATORS = CUTS | byte_set(b" \t")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
W = ["w1", "w2", "w3", "w4"]


def _summed(rows: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows become one (but where two rows share a hash, some may stay apart)."""
    key = mix(rows[0].view(np.uint64))
    for column in rows[1:]:
        key = mix(key + column.view(np.uint64))
    order = np.argsort(key)
    rows = [c[order] for c in rows]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in rows])
    first = np.flatnonzero(new)
    return [c[first] for c in rows], np.add.reduceat(n[order], first) if len(first) else n[:0]


def lowered(found: Slice) -> Slice:
    return Slice(found.first, LOWER[found.data], found.bounds, found.starts, found.ends, found.cuts)


def lang_words(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[Slice, np.ndarray, list[str]]]:
    """Slices in lower case, the hash of each word with its language, and the languages of the texts."""
    langs = batch.column("lang").to_pylist()
    salt = {x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in set(langs)}
    salts = np.array([salt[x] for x in langs], dtype=np.uint64)
    for found in slices(batch.column("text"), SEPARATORS):
        found = lowered(found)
        own = salts[found.first : found.first + len(found.cuts) - 1]
        # One bit less than 64 leaves the negative numbers to words without a short number.
        hashes = (mix(found.hashes(seed) + own[found.owners()]) >> np.uint64(1)).astype(np.int64)
        yield found, hashes, langs[found.first : found.first + len(found.cuts) - 1]


def vocabulary(docs: DataFrame, seed: int) -> DataFrame:
    """(h, lang, word, n) for all words, with ``clash`` where different words share the hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def folded() -> pa.Table:
            whole = pa.concat_tables(held)
            h, n = whole["h"].to_numpy(), whole["n"].to_numpy()
            _, first, at = np.unique(h, return_index=True, return_inverse=True)
            # Only sums over equal words: rows of one hash but another word stay as they are.
            words, langs = whole["word"].combine_chunks(), whole["lang"].combine_chunks()
            same = words.equals(words.take(pa.array(first[at]))) and langs.equals(langs.take(pa.array(first[at])))
            if not same:
                return whole
            total = np.bincount(at, weights=n).astype(np.int64)
            return whole.take(pa.array(first)).set_column(3, "n", pa.array(total))

        for batch in batches:
            for found, hashes, langs in lang_words(batch, seed):
                if not len(hashes):
                    continue
                # Words are told apart by hash and length here; a clash shows in the words that are kept.
                _, first, at = np.unique(hashes, return_index=True, return_inverse=True)
                names = pa.array(langs, type=pa.string()).take(pa.array(found.owners()[first]))
                word = texts_column(found.data, found.starts[first], found.ends[first])
                held.append(pa.table({"h": hashes[first], "lang": names, "word": word, "n": np.bincount(at)}))
            if sum(t.num_rows for t in held) > HELD:
                held = [folded()]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from folded().to_batches()

    rows = docs.mapInArrow(count, "h long, lang string, word string, n long")
    return rows.groupBy("h").agg(
        F.sum("n").alias("n"),
        F.min("lang").alias("lang"),
        F.min("word").alias("word"),
        ((F.min("lang") != F.max("lang")) | (F.min("word") != F.max("word"))).alias("clash"),
    )


class Numbers:
    """Short numbers for the most frequent words; the rest keep their hash as a negative number, or are rare."""

    def __init__(self, words: DataFrame, least: int, most: int = 0):
        most = most or MOST_WORDS
        classes = words.groupBy(F.floor(F.log2("n")).cast("int").alias("c")).agg(F.count("*").alias("n")).collect()
        limit = least
        for row in sorted(classes, key=lambda r: r["c"]):
            if sum(r["n"] for r in classes if r["c"] >= row["c"]) <= most:
                break
            limit = 2 ** (row["c"] + 1)
        self.complete = limit <= least
        found = words.where(F.col("n") >= limit).select("h", "n").toArrow()
        h, n = found["h"].to_numpy(), found["n"].to_numpy()
        ranked = h[np.lexsort((h, -n))]
        order = np.argsort(ranked)
        self.keys, self.number = ranked[order], (order + 1).astype(np.int32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """0 for a word that is too rare to matter."""
        other = np.zeros(len(hashes), dtype=np.int64) if self.complete else ~hashes
        if not len(self.keys):
            return other
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.number[at].astype(np.int64), other)


def grams(found: Slice, ids: np.ndarray) -> list[np.ndarray]:
    """w1 to w4 of all edges, edges to a piece's end, and pieces of one or two words."""
    cuts = np.zeros(len(found.data) + 1, dtype=np.int32)
    np.cumsum(CUTS[found.data], out=cuts[1:])
    owner = found.owners()
    last = np.ones(len(ids), dtype=bool)
    last[:-1] = (
        (owner[1:] != owner[:-1]) | (cuts[found.starts[1:]] != cuts[found.ends[:-1]]) | (ids[1:] == 0) | (ids[:-1] == 0)
    )
    stop = np.flatnonzero(last) + 1
    sizes = np.diff(np.concatenate([[0], stop]))
    rest = np.repeat(stop, sizes) - np.arange(len(ids))
    whole = np.repeat(sizes, sizes)
    begin = np.flatnonzero((ids != 0) & ((rest >= 3) | (rest == whole)))
    rest = rest[begin]
    padded = np.concatenate([ids, np.zeros(3, dtype=np.int64)])
    return [np.where(rest > i, padded[begin + i], 0) for i in range(4)]


def edges(docs: DataFrame, numbers, seed: int) -> DataFrame:
    """(w1, w2, w3, w4, n): sums by task of all rows of ``grams``."""

    def emit(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        rows, n = _summed([np.concatenate(c) for c in zip(*parts)], np.ones(sum(len(p[0]) for p in parts), dtype=np.int64))
        return pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(n)], [*W, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for found, hashes, _ in lang_words(batch, seed):
                kinds, at = np.unique(hashes, return_inverse=True)
                held.append(grams(found, numbers.value.of(kinds)[at]))
                size += len(held[-1][0])
                if size > HELD:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    return docs.mapInArrow(count, ", ".join(f"{w} long" for w in [*W, "n"]))


def _first(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new run of equal rows begins."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def flows(least: int):
    """Of rows sorted by node and edge: sums of runs of four words, and the flows of shorter ones.

    Runs of three and four words lie together. Those below ``least`` go no further, but for the
    first and the last node of a batch, which may go on in another.
    """

    def run(batch: pa.RecordBatch) -> pa.Table:
        w1, w2, w3, w4, n = (batch.column(i).to_numpy() for i in range(5))
        zero = np.zeros(len(n), dtype=np.int64)
        out = []

        def add(columns: list[np.ndarray], weight: np.ndarray, all_kept: bool = False) -> None:
            at = _first(columns)
            total = np.add.reduceat(weight, at)
            keep = np.ones(len(at), dtype=bool) if all_kept else (total >= least) | ((inner[at] == 0) | (inner[at] == inner[-1]))
            out.append([*(c[at][keep] for c in columns), total[keep]])

        node = _first([w1, w2, w3])
        inner = np.repeat(np.arange(len(node)), np.diff(np.append(node, len(n))))
        rows = [w1, w2, w3, w4]
        for size, kept in ((4, False), (3, False), (2, True), (1, True)):
            long = np.flatnonzero(rows[size - 1])
            if len(long):
                whole, inner_all = [c[long] for c in rows[:size]] + [zero[long]] * (4 - size), inner
                inner = inner_all[long]
                add(whole, n[long], kept)
                inner = inner_all
        # What stands at a piece's end and begins no longer run: its last two words, and each of them.
        three = np.flatnonzero((w3 != 0) & (w4 == 0))
        two = np.flatnonzero((w2 != 0) & (w3 == 0))
        ends2 = [w2[three], w3[three]]
        ends1 = np.concatenate([w2[three], w3[three], w2[two]])
        z = np.zeros(len(ends1), dtype=np.int64)
        for columns, weight in (
            ([*ends2, z[: len(three)], z[: len(three)]], n[three]),
            ([ends1, z, z, z], n[np.concatenate([three, three, two])]),
        ):
            if len(weight):
                columns, weight = _summed(columns, weight)
                out.append([*columns, weight])
        return pa.table({name: np.concatenate([part[i] for part in out]) for i, name in enumerate([*W, "n"])})

    return per_batch(run)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts (w1, w2, w3, w4, n) of all phrases of one to four words that occur ``least`` times, names of the
    numbers (w, lang, word), and words by language (lang, n). ``docs`` has the columns text and lang."""
    spark = docs.sparkSession
    seed = 0
    while True:
        words = staged(vocabulary(docs, seed), "vocabulary")
        frequent = words.where(F.col("n") >= least)
        if frequent.where("clash").isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    numbers = spark.sparkContext.broadcast(Numbers(frequent, least))

    def name(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = numbers.value.of(batch.column("h").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(ids), batch.column("lang"), batch.column("word")], ["w", "lang", "word"])

    names = frequent.select("h", "lang", "word").mapInArrow(per_batch(name), "w long, lang string, word string")
    rows = edges(docs, numbers, seed).repartition("w1", "w2", "w3").sortWithinPartitions(*W)
    rows = rows.mapInArrow(flows(least), ", ".join(f"{w} long" for w in [*W, "n"]))
    counts = rows.groupBy(*W).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return staged(counts, "phrases"), staged(names, "names"), staged(totals, "totals")


def paths(counts: DataFrame) -> DataFrame:
    """(w1, w2, w3, w4, head, place): of each edge the path it lies on, by its first edge, and its place there."""
    edge = counts.where("w4 <> 0").withColumn("e", F.struct(*W))
    node = counts.where("w3 <> 0 and w4 = 0").select(*W[:3], F.col("n").alias("flow"))
    into = edge.select(F.col("e").alias("before"), F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3"), "n")
    unary = into.join(node, W[:3]).where("n = flow").drop("flow")
    # An edge and the one before it, where the node between them is unary.
    step = unary.join(edge.select("e", *W[:3], "n"), [*W[:3], "n"]).select("e", "before")
    jumps = staged(
        edge.select("e").join(step, "e", "left").select("e", F.coalesce("before", "e").alias("head"), F.col("before").isNotNull().cast("long").alias("place")),
        "paths",
    )
    # A path begins at an edge without one before it: a circle of unary nodes alone has no piece that enters it.
    while True:
        past = jumps.select(F.col("e").alias("head"), F.col("head").alias("far"), F.col("place").alias("more"))
        jumps = staged(
            jumps.where("place = 0").unionByName(
                jumps.where("place > 0").join(past, "head").select("e", F.col("far").alias("head"), (F.col("place") + F.col("more")).alias("place"))
            ),
            "paths",
        )
        ahead = jumps.where("place > 0").select(F.col("head").alias("e")).distinct()
        if jumps.where("place > 0").join(ahead, "e", "left_semi").isEmpty():
            return jumps.select("e.*", "head", "place")


def _key(*columns):
    """The words of a phrase as the key of its count."""
    whole = [*map(F.col, columns), *[F.lit(0).cast("long")] * (4 - len(columns))]
    return F.struct(*(c.alias(w) for c, w in zip(whole, W)))


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language by score, with their counts, parts and the length of the
    compacted path that a phrase of four words lies on (``path_words``)."""
    docs = docs.select(F.col(text_column).alias("text"), F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"))
    counts, names, totals = phrase_counts(docs, least)
    walked = staged(paths(counts), "walked")
    lengths = walked.groupBy("head").agg((F.count("*") + 3).alias("path_words"))
    lengths = walked.join(lengths, "head").select(*W, "path_words")
    # The last words of all edges but a path's first one pass a unary node: no candidates any more.
    inner = walked.where("place > 0").select(*W[:3]).distinct()
    phrases = counts.where("w2 <> 0").withColumn("size", F.expr("int(w2 <> 0) + int(w3 <> 0) + int(w4 <> 0) + 1"))
    longer = phrases.where("size > 2").withColumn("size", F.col("size") - 1)
    shown = F.when(F.col("size") == 3, F.array(_key(*W[:3]), _key(*W[1:]))).otherwise(
        F.array(_key(*W[:2]), _key(*W[1:3]))
    )
    held = longer.select(F.explode(shown).alias("p"), "n").groupBy(*[F.col(f"p.{w}").alias(w) for w in W]).agg(F.max("n").alias("most"))
    kept = phrases.join(inner.withColumn("w4", F.lit(0).cast("long")), W, "left_anti").join(held, W, "left")
    wide = "decimal(38,0)"
    kept = kept.where(F.col("most").isNull() | (F.lit(100).cast(wide) * F.col("most").cast(wide) < F.lit(share).cast(wide) * F.col("n").cast(wide)))
    kept = staged(kept.select(*W, "size", F.col("n").alias("a")), "kept")
    # Both parts of each cut, looked up among the counts.
    sides = []
    for size in (2, 3, 4):
        for k in range(1, size):
            for left, part in ((True, W[:k]), (False, W[k:size])):
                value = F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), _key(*part).alias("p"))
                sides.append(F.when(F.col("size") == size, value))
    asked = kept.select(F.struct(*W).alias("c"), "a", F.explode(F.filter(F.array(*sides), lambda x: x.isNotNull())).alias("s"))
    asked = asked.select("c", "a", "s.k", "s.left", "s.p.*")
    found = asked.join(counts, W).groupBy("c", "k").agg(
        F.first("a").alias("a"),
        F.sum(F.when(F.col("left"), F.col("n"))).alias("l"),
        F.sum(F.when(~F.col("left"), F.col("n"))).alias("r"),
    )
    score = F.expr(f"cast(2000000 as {wide}) * cast(a as {wide}) div (cast(l as {wide}) + cast(r as {wide}))")
    best = found.withColumn("score", score).groupBy("c").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("b"))
    best = staged(best.select("c.*", "a", "b.*"), "scored")
    spelt = (
        best.select(F.struct(*W).alias("c"), F.posexplode(F.filter(F.array(*W), lambda x: x != 0)).alias("at", "w"))
        .join(names, "w")
        .groupBy("c")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"), F.min("lang").alias("lang"))
        .select("c.*", "phrase", "lang")
    )
    rows = best.join(spelt, W).join(lengths, W, "left")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "path_words")


@register("op11_collocations")
def op11(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
