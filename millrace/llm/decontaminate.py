"""Benchmark decontamination: test items inside documents, by MinHash containment, verified exactly.

A document contains an item if at least 0.8 of the item's distinct shingles (five words, lower case)
occur anywhere in it. Documents are long and items short, so that the two sets' Jaccard index says
little; the search therefore asks for containment:

* Items are partitioned by size (powers of two of distinct shingles). The size of a partition tells
  how many registers its items get and which documents are too short to contain any of them.
* A register holds the shingle of the item with the least value of the register's hash function. A
  document that contains the item has that shingle with a probability of its containment, whatever
  the document's length. With 16 registers an item contained at 0.8 has none in the document with a
  probability below 1e-11; an item of at most 16 shingles has all of them as registers.
* A document with any register of an item is a candidate, and is verified on all shingles of both.

Items come in blocks of at most ``BLOCK`` shingles (a block also ends with the item that passes it).
A block is sent to the tasks, and all documents pass by each block once, without a shuffle or join.

Defined results: null and wordless texts contain nothing, null and wordless items are contained in
nothing. An item of one to four words is searched as a whole, at the width it has. Repeated items
each count, repeated documents each give rows; ids may be null or repeat. Empty tables give empty
results. Further columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import per_batch, refuse_names, register, table, texts_of
from .words import mix, shingles, word_hashes

WIDTH = 5
THRESHOLD = 0.8
REGISTERS = 16
BLOCK = 2_000_000
SLOTS = np.uint64(22)


def item_sets(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Width and distinct shingles of each text."""
    for _, hashes, bounds in word_hashes(texts):
        for start, end in zip(bounds[:-1], bounds[1:]):
            width = int(min(WIDTH, end - start))
            found = shingles(hashes[start:end], np.array([0, end - start]), width or 1)[0]
            yield width, np.unique(found)


def registers(found: np.ndarray) -> np.ndarray:
    """The shingle of least value for each hash function; all of a small set."""
    if len(found) <= REGISTERS:
        return found
    seeds = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64))
    return np.unique(found[mix(found[:, None] ^ seeds[None, :]).argmin(axis=0)])


class _Lookup:
    """Which of many keys stand in a table, and for which items."""

    def __init__(self, keys: np.ndarray, items: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.items = items[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(keys)))
        self.taken = np.zeros(1 << int(SLOTS), dtype=bool)
        self.taken[self.keys >> (np.uint64(64) - SLOTS)] = True

    def hits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``found`` and items of all matches."""
        at = np.flatnonzero(self.taken[found >> (np.uint64(64) - SLOTS)])
        place = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
        same = self.keys[place] == found[at]
        at, place = at[same], place[same]
        count = self.count[place]
        ends = np.cumsum(count)
        inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        return np.repeat(at, count), self.items[np.repeat(self.first[place], count) + inner]


class Block:
    """Some items, ready for search: registers by width and size, and all shingles for the check."""

    def __init__(self, ids: list, sets: list[tuple[int, np.ndarray]]):
        self.ids = ids
        self.sizes = np.array([len(found) for _, found in sets], dtype=np.int64)
        groups = defaultdict(list)
        for i, (width, found) in enumerate(sets):
            if width:
                groups[width, len(found).bit_length() - 1].append(i)
        self.parts = []
        for (width, power), members in sorted(groups.items()):
            regs = [registers(sets[i][1]) for i in members]
            owners = np.repeat(np.array(members), [len(r) for r in regs])
            least = int(np.ceil(THRESHOLD * (1 << power) - 1e-9))
            self.parts.append((width, least, _Lookup(np.concatenate(regs), owners)))
        self.whole = {}
        for width in {w for w, _, _ in self.parts}:
            members = [i for i, (w, _) in enumerate(sets) if w == width]
            owners = np.repeat(np.array(members), self.sizes[members])
            self.whole[width] = _Lookup(np.concatenate([sets[i][1] for i in members]), owners)

    def matches(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, item and number of shared shingles of all contained items."""
        for first, hashes, bounds in word_hashes(texts):
            n_items = len(self.ids)
            for width, whole in self.whole.items():
                found, at = shingles(hashes, bounds, width)
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
                sizes = np.diff(at)
                pairs = []
                for _, least, lookup in (p for p in self.parts if p[0] == width):
                    place, items = lookup.hits(found)
                    fits = sizes[owner[place]] >= least
                    pairs.append(np.unique(owner[place[fits]] * n_items + items[fits]))
                pairs = np.unique(np.concatenate(pairs))
                if not len(pairs):
                    continue
                # The exact check: distinct shingles of candidate texts in candidate items.
                mask = np.zeros(len(bounds) - 1, dtype=bool)
                mask[pairs // n_items] = True
                mine = mask[owner]
                place, items = whole.hits(found[mine])
                text, key = owner[mine][place], found[mine][place]
                order = np.lexsort((key, items, text))
                text, items, key = text[order], items[order], key[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (items[1:] != items[:-1]) | (text[1:] != text[:-1])
                both, shared = np.unique(text[new] * n_items + items[new], return_counts=True)
                good = (shared >= THRESHOLD * self.sizes[both % n_items] - 1e-9) & np.isin(both, pairs)
                yield first + both[good] // n_items, both[good] % n_items, shared[good]


def blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[Block]:
    """The items, a bounded number of shingles at a time."""
    ids, sets, size = [], [], 0
    for row in benchmark.select(id_column, text_column).toLocalIterator():
        ids.append(row[0])
        sets.extend(item_sets([row[1] or ""]))
        size += len(sets[-1][1])
        if size >= BLOCK:
            yield Block(ids, sets)
            ids, sets, size = [], [], 0
    if size:
        yield Block(ids, sets)


def _schema(df: DataFrame, column: str, name: str) -> str:
    return f"`{name}` {df.schema[column].dataType.simpleString()}"


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row for each document and item it contains: id, item_id, n_shared, n_item, containment."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    refuse_names(id_column, "item_id", "n_shared", "n_item", "containment", "text")
    item_type = to_arrow_type(benchmark.schema[item_column].dataType)
    schema = f"{_schema(docs, id_column, id_column)}, {_schema(benchmark, item_column, 'item_id')}, n_shared long, n_item long"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_column, item_text):
        sent = spark.sparkContext.broadcast(block)

        def search(batch: pa.RecordBatch, sent=sent) -> pa.Table | None:
            items = sent.value
            parts = list(items.matches(texts_of(batch)))
            if not parts:
                return None
            text, item, shared = (np.concatenate(x) for x in zip(*parts))
            return pa.table(
                {
                    id_column: batch.column(id_column).take(pa.array(text)),
                    "item_id": pa.array([items.ids[i] for i in item], type=item_type),
                    "n_shared": pa.array(shared.astype(np.int64)),
                    "n_item": pa.array(items.sizes[item]),
                }
            )

        out = out.unionByName(source.mapInArrow(per_batch(search), schema))
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents that contain no item; all columns stay."""
    for block in blocks(benchmark, item_column, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            keep = np.ones(batch.num_rows, dtype=bool)
            for text, _, _ in sent.value.matches(texts_of(batch, text_column)):
                keep[text] = False
            return batch.filter(pa.array(keep))

        docs = docs.mapInArrow(per_batch(clean), docs.schema)
    return docs


@register("op2_decontaminate")
def op2(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
