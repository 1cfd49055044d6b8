"""Near duplicates by ProbMinHash: signatures of weighted shingles, banding, exact verification.

A document is a set of word shingles (five words, lower case), weighted by how often they occur in
it. The similarity of two documents is the probability Jaccard index of these weights, which is the
plain Jaccard index where nothing repeats. Links are pairs of 0.8 or more, and a class is a
connected component of links.

* Each shingle is a Poisson process of arrivals at a rate equal to its weight; each arrival falls
  into a random register, and a register keeps the shingle that arrived first. A process ends as
  soon as its next arrival comes after the last first arrival of all registers.
* Documents with equal weights are one node; copies never meet as pairs.
* 24 bands of four registers: a pair of similarity 0.8 shares no band with a probability of 3e-6.
* Of buckets that hold the same nodes one is looked at.
* Within a bucket each node is compared with two centres. Where a bucket then still holds several
  components, the nodes outside its main component are held against all nodes of other components, in blocks: first each
  names the one it differs least from, round after round while that joins enough of them; then all pairs left are compared, so
  that no link between components is missed.
* Pairs that cannot be similar enough are left out there by two bounds, not guesses: one of the two has too many
  shingles found nowhere else, or the parities of their shingles, counted in 1,024 classes, differ in more classes than
  the difference of two similar documents has shingles. They keep families of loosely similar documents from
  becoming all pairs.
* A pair whose signatures agree in fewer than 55 % of the registers (six standard errors below 0.8) is not
  verified; all others are, on whole texts.

Defined results: null text counts as empty. Texts without a word belong together if they are equal.
Texts of fewer than five words are one shingle. Rows of equal id and equal text are one document as
far as classes go; ``keep`` marks both, and ``drop_near_duplicates`` keeps one. The class id is the
smallest id in the class (nulls aside; null if it has no other). An empty table gives an empty one.
Further columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import may_have
from .common import free_name, gathered, per_batch, refuse_names, register, staged, table, text_hash, texts_of
from .components import connected
from .words import mix, shingles, word_hashes

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
LEAST_AGREEMENT = 0.55
# Classes of shingles whose parities tell documents apart, in words of 64 bits.
MARKS = 16
# Nodes of a bucket that are compared in one task.
BLOCK = 4096
# Centres of a bucket that each of its nodes is compared with first.
CENTRES = 2
# Another round is held after one that found a link for one in so many of its nodes at least.
ROUND_SHARE = 50
# Shingle ids within a batch: the text's number above 52 bits of hash.
ID_BITS = np.uint64(52)
ID_MASK = np.uint64((1 << 52) - 1)
# Bytes of a row with a signature, and of one with a text, as far as the number of tasks goes.
WIDE, TEXT = 700, 4000


def weighted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by text: owner, 52-bit id, weight; sorted by owner and id."""
    found, at = shingles(hashes, bounds, WIDTH)
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(at))
    keys = np.sort((owner << ID_BITS) | (found >> np.uint64(12)))
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    place = np.flatnonzero(first)
    keys, weight = keys[place], np.diff(np.append(place, len(keys)))
    return (keys >> ID_BITS).astype(np.int64), keys & ID_MASK, weight


def signatures(owner: np.ndarray, ids: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` sets, the shingle that arrives first in each register (0 for an empty set)."""
    earliest = np.full(count * REGISTERS, np.inf)
    winner = np.zeros(count * REGISTERS, dtype=np.uint64)
    state = mix(ids ^ np.uint64(0x5851F42D4C957F2D))
    rate = weight.astype(float)
    clock = np.zeros(len(ids))
    last = np.full(count, np.inf)
    while len(ids):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        clock = clock - np.log(((state >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
        live = clock < last[owner]
        owner, ids, rate, state, clock = owner[live], ids[live], rate[live], state[live], clock[live]
        slot = owner * REGISTERS + (mix(state ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(earliest, slot, clock)
        won = earliest[slot] == clock
        winner[slot[won]] = ids[won]
        open_sets = np.unique(owner)
        last[open_sets] = earliest.reshape(count, REGISTERS)[open_sets].max(axis=1)
    return winner.reshape(count, REGISTERS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One long for each band of each signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def node_ids(owner: np.ndarray, ids: np.ndarray, weight: np.ndarray, texts: list[str]) -> np.ndarray:
    """A 64-bit id of each weighted set; of a text without words, an id of the text itself."""
    sums = np.zeros(len(texts), dtype=np.uint64)
    np.add.at(sums, owner, mix(mix(ids) + weight.astype(np.uint64)))
    empty = np.ones(len(texts), dtype=bool)
    empty[owner] = False
    out = mix(sums)
    for i in np.flatnonzero(empty):
        digest = hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype=np.uint64)[0]
    return out.view(np.int64)


def sketches(id_column: str):
    """Arrow batches of (id, thash, k, text) to (id, thash, k, node, wordless, bands, signature)."""

    def sketch(batch: pa.RecordBatch) -> pa.Table:
        texts = texts_of(batch)
        parts = []
        for first, hashes, bounds in word_hashes(texts):
            count = len(bounds) - 1
            owner, ids, weight = weighted(hashes, bounds)
            node = node_ids(owner, ids, weight, texts[first : first + count])
            signature = signatures(owner, ids, weight, count)
            wordless = np.diff(bounds) == 0
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(signature).ravel()), BANDS)
            bands = bands.cast(pa.list_(pa.int64()))
            packed = [r.tobytes() for r in (mix(signature) >> np.uint64(32)).astype(np.uint32)]
            parts.append(
                pa.table(
                    {
                        id_column: batch.column(id_column).slice(first, count),
                        "thash": batch.column("thash").slice(first, count),
                        "k": batch.column("k").slice(first, count),
                        "node": pa.array(node),
                        "wordless": pa.array(wordless),
                        "bands": bands,
                        "signature": pa.array(packed, type=pa.binary()),
                    }
                )
            )
        return pa.concat_tables(parts)

    return per_batch(sketch)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared shingles of 1 / sum of max(x'/x, y'/y), for (ids, weights) sorted by id."""
    shared, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][at_a].astype(float), b[1][at_b].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    # Larger ratios count as x'/x, the rest as y'/y; shingles of one side only count there.
    below = np.searchsorted(ratio, ratio, side="right")
    head = np.concatenate([[0.0], np.cumsum(y)])[below] + (b[1].sum() - y.sum())
    tail = a[1].sum() - np.concatenate([[0.0], np.cumsum(x)])[below]
    return float((1.0 / (tail / x + head / y)).sum())


def _verified(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
    texts = list(dict.fromkeys(left + right))
    sets = {}
    for first, hashes, bounds in word_hashes(texts):
        owner, ids, weight = weighted(hashes, bounds)
        cut = np.searchsorted(owner, np.arange(len(bounds)))
        for i in range(len(bounds) - 1):
            sets[texts[first + i]] = ids[cut[i] : cut[i + 1]], weight[cut[i] : cut[i + 1]]
    good = [probability_jaccard(sets[a], sets[b]) >= THRESHOLD - 1e-9 for a, b in zip(left, right)]
    return batch.select(["a", "b"]).filter(pa.array(good))


def _weights(batch: pa.RecordBatch) -> pa.Table:
    nodes, parts = batch.column("node").to_numpy(), []
    for first, hashes, bounds in word_hashes(texts_of(batch)):
        owner, ids, weight = weighted(hashes, bounds)
        parts.append(pa.table({"node": nodes[first + owner], "shingle": ids.view(np.int64), "weight": weight.astype(np.int64)}))
    return pa.concat_tables(parts)


def _sizes(batch: pa.RecordBatch) -> pa.Table:
    nodes, parts = batch.column("node").to_numpy(), []
    for first, hashes, bounds in word_hashes(texts_of(batch)):
        owner, ids, weight = weighted(hashes, bounds)
        n = len(bounds) - 1
        most = np.zeros(n, dtype=np.int64)
        np.maximum.at(most, owner, weight)
        size = np.bincount(owner, weights=weight, minlength=n).astype(np.int64)
        marks = pa.FixedSizeListArray.from_arrays(pa.array(parities(owner, ids, np.ones_like(weight), n).ravel()), MARKS)
        marks = marks.cast(pa.list_(pa.int64()))
        parts.append(pa.table({"node": nodes[first : first + n], "size": size, "plain": most == 1, "marks": marks}))
    return pa.concat_tables(parts)


def parities(owner: np.ndarray, ids: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """For each set, the parity of its elements in each of ``64 * MARKS`` classes, as bits.

    A shingle of weight three is three elements. Two sets differ in at least as many elements as their bits differ.
    """
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    place = mix(mix(np.repeat(ids, weight)) + nth.astype(np.uint64)) >> np.uint64(64 - (64 * MARKS).bit_length() + 1)
    found = np.bincount(np.repeat(owner, weight) * (MARKS * 64) + place.astype(np.int64), minlength=count * MARKS * 64)
    return np.packbits((found & 1).astype(np.uint8).reshape(count, -1), axis=1).view(np.int64)


def _alike(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    a, b = (
        np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, REGISTERS)
        for c in ("sig_a", "sig_b")
    )
    return batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= LEAST_AGREEMENT))


# Shingles that only one of the two has leave at most so much to share. Of sets, the similarity is the
# Jaccard index, and what is shared must be 0.8 / 1.8 of both; of weights, neither may lack more than a fifth.
ROOM = f"""
    CASE WHEN m.plain AND c.plain
    THEN least(m.size - m.alone, c.size - c.alone) >= {THRESHOLD} / (1 + {THRESHOLD}) * (m.size + c.size) - 1e-6
    ELSE m.alone <= {1 - THRESHOLD} * m.size + 1e-6 AND c.alone <= {1 - THRESHOLD} * c.size + 1e-6 END"""


def may_be_similar(left: dict[str, np.ndarray], right: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (left by right) both bounds allow, and in how many classes of ``parities`` each pair differs.

    The parities are those of the distinct shingles. Two similar sets differ in a ninth of both at most. Of weights x and y,
    no shared shingle i adds more to the similarity than max(x_i, y_i) / M, where M is the sum of all max(x_j, y_j); so those
    of one side only weigh a fifth of M at most, and M is half of both sizes and of the difference that a total variation of a
    fifth between their shares and the difference in size allow.
    """
    apart = np.zeros((len(left["size"]), len(right["size"])), dtype=np.int16)
    for i in range(MARKS):
        apart += np.bitwise_count(left["marks"][:, i, None] ^ right["marks"][None, :, i])
    a, b = left["size"][:, None].astype(float), right["size"][None, :].astype(float)
    alone_a, alone_b = left["alone"][:, None], right["alone"][None, :]
    plain = left["plain"][:, None] & right["plain"][None, :]
    most = np.where(plain, (1 - THRESHOLD) / (1 + THRESHOLD) * (a + b), (1 - THRESHOLD) / 2 * (a + b + 2 * (1 - THRESHOLD) * np.minimum(a, b) + np.abs(a - b)))
    room = np.where(
        plain,
        np.minimum(a - alone_a, b - alone_b) >= THRESHOLD / (1 + THRESHOLD) * (a + b) - 1e-6,
        (alone_a <= (1 - THRESHOLD) * a + 1e-6) & (alone_b <= (1 - THRESHOLD) * b + 1e-6),
    )
    return room & (apart <= most + 1e-6), apart


def _candidates(best: bool):
    """Pairs of a block of a bucket that lie in different components and may be similar.

    With ``best`` each node outside the main component names one of another component, the one that differs least;
    else all pairs, each in the first bucket that it shares (``bands`` are 0 where the bucket is not looked at).
    """

    def run(table: pa.Table) -> pa.Table:
        whole = {c: table[c].to_numpy() for c in ("node", "component", "main", "size", "alone", "plain", "left", "bucket")}
        # Unsigned: of a negative number the bits of its absolute value would be counted.
        whole["marks"] = table["marks"].combine_chunks().flatten().to_numpy().reshape(-1, MARKS).view(np.uint64)
        whole["bands"] = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        left, right = ({c: v[whole["left"] == side] for c, v in whole.items()} for side in (True, False))
        found = []
        for first in range(0, len(left["node"]), 256):
            some = {c: v[first : first + 256] for c, v in left.items()}
            good, apart = may_be_similar(some, right)
            good &= some["component"][:, None] != right["component"][None, :]
            if best:
                share = np.where(good, apart / (some["size"][:, None] + right["size"][None, :]), np.inf)
                x = np.flatnonzero(good.any(axis=1))
                y = share[x].argmin(axis=1) if len(x) else x
            else:
                good &= (right["component"] == right["main"])[None, :] | (some["node"][:, None] < right["node"][None, :])
                x, y = np.nonzero(good)
                same = (some["bands"][x] == right["bands"][y]) & (some["bands"][x] != 0)
                once = some["bands"][x, same.argmax(axis=1)] == some["bucket"][x]
                x, y = x[once], y[once]
            found.append((some["node"][x], right["node"][y]))
        a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 2
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _pair():
    return F.least("m.node", "c.node").alias("a"), F.greatest("m.node", "c.node").alias("b")


class _Search:
    """Nodes, their buckets and their texts, and the links found so far."""

    def __init__(self, docs: DataFrame, id_column: str, rows: DataFrame):
        nodes = staged(
            rows.where("not wordless")
            .groupBy("node")
            .agg(F.min_by(F.struct("k", "bands", "signature"), "k").alias("d"))
            .select("node", "d.k", "d.bands", "d.signature"),
            "nodes",
            rows.count(),
            WIDE,
        )
        self.signatures = nodes.select("node", "signature")
        size = nodes.count()
        members = nodes.select("node", F.explode("bands").alias("bucket"))
        crowded = members.groupBy("bucket").agg(
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.count("*").alias("n"),
            *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"all{i}") for i in range(2)],
        )
        # Nodes that are alike meet in most of their buckets; of those with the same nodes (128 bits tell sets apart) one stays.
        crowded = crowded.where("low <> high").groupBy("low", "high", "n", "all0", "all1").agg(F.min("bucket").alias("bucket"))
        crowded = staged(crowded.select("bucket"), "crowded", size * BANDS, 24)
        met = staged(members.join(crowded, "bucket", "left_semi"), "met", size * BANDS, 24)
        self.n_members = met.count()
        # Only nodes that share a bucket are looked at from here on.
        wanted = staged(nodes.select("node", "k").join(met.select("node").distinct(), "node"), "wanted", size, 24)
        self.size = wanted.count()
        texts = docs.select(F.xxhash64(id_column, F.coalesce("text", F.lit(""))).alias("k"), "text")
        texts = may_have(texts, wanted.select("k")).join(wanted, "k").select("node", "text")
        self.texts = staged(texts.dropDuplicates(["node"]), "texts", self.size, TEXT)
        self.members = staged(met.join(self.alone(), "node"), "members", self.n_members, 64)
        kept = met.groupBy("node").agg(F.collect_list("bucket").alias("kept"))
        bands = F.transform("bands", lambda b: F.when(F.array_contains("kept", b), b).otherwise(0))
        self.nodes = staged(nodes.join(kept, "node").select("node", bands.alias("bands")), "banded", self.size, 240)

    def alone(self) -> DataFrame:
        """(node, size, alone, plain): all weight, that of shingles no other node of these has, and whether all weigh one."""
        one = self.texts.mapInArrow(per_batch(_weights), "node long, shingle long, weight long")
        rare = one.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("weight").alias("w"))
        rare = rare.where("n = 1").groupBy("node").agg(F.sum("w").alias("alone"))
        rare = staged(rare, "rare", self.size, 24)
        whole = self.texts.mapInArrow(per_batch(_sizes), "node long, size long, plain boolean, marks array<long>")
        whole = staged(whole.join(rare, "node", "left").fillna(0, ["alone"]), "alone", self.size, 160)
        self.marks = whole.select("node", "marks")
        return whole.drop("marks")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The links among the staged table of pairs (a, b)."""
        n = pairs.count()
        if not n:
            return pairs
        alike = (
            pairs.join(self.signatures.toDF("a", "sig_a"), "a")
            .join(self.signatures.toDF("b", "sig_b"), "b")
            .select("a", "b", "sig_a", "sig_b")
        )
        alike = gathered(alike, n, 2 * WIDE).mapInArrow(per_batch(_alike), "a long, b long")
        alike = staged(alike, "alike")
        checked = (
            alike.join(self.texts.toDF("a", "text_a"), "a")
            .join(self.texts.toDF("b", "text_b"), "b")
            .select("a", "b", "text_a", "text_b")
        )
        return staged(gathered(checked, alike.count(), 2 * TEXT).mapInArrow(per_batch(_verified), "a long, b long"), "verified")

    def links(self) -> DataFrame:
        """(node, component) of all nodes with a link."""
        if not self.n_members:
            return self.nodes.select("node", F.col("node").alias("component")).limit(0)
        # Centres: the node with the least share of shingles of its own, the smallest, and some by hash.
        node = F.struct("node", "size", "alone", "plain")
        ranks = [F.struct(F.col("alone") / F.col("size"), "node"), F.struct(F.lit(0.0), "node")]
        ranks += [F.struct(F.xxhash64("node", "bucket", F.lit(i)).cast("double"), "node") for i in range(CENTRES - 2)]
        centres = self.members.groupBy("bucket").agg(*[F.min_by(node, r).alias(f"c{i}") for i, r in enumerate(ranks)])
        centres = centres.select("bucket", F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)])).alias("all"))
        centres = staged(centres, "centres", self.n_members, 48)
        # One row of centres for each member; pairs are made of it.
        met = self.members.join(centres, "bucket").select(node.alias("m"), F.explode("all").alias("c"))
        pairs = met.where("m.node <> c.node").where(ROOM)
        compared = staged(pairs.select(*_pair()).distinct(), "pairs", self.n_members, 24)
        links = self.verify(compared)
        component = staged(connected(links), "component", self.size, 24)
        turn = 0
        while True:
            mixed = self.mixed(component)
            if mixed is None:
                return component
            # Components that belong together grow together by a link a node; what is then still apart is compared whole.
            blocks = self.blocks(mixed, turn)
            named = self.named(blocks, True, compared)
            found = self.verify(named)
            n_found = found.count()
            if not n_found:
                break
            compared = staged(compared.unionByName(named), "compared")
            links = staged(links.unionByName(found), "all-links")
            component = staged(connected(links), "component", self.size, 24)
            turn += 1
            if n_found * ROUND_SHARE < blocks.where("left").agg(F.count_distinct("node")).first()[0]:
                # The rest is compared under the components before this round, which are parts of the present ones.
                break
        found = self.verify(self.named(self.blocks(mixed), False, compared))
        return component if found.isEmpty() else connected(links.unionByName(found))

    def named(self, blocks: DataFrame, best: bool, compared: DataFrame) -> DataFrame:
        """The pairs (a, b) of the blocks that are still to be compared."""
        pairs = blocks.groupBy("bucket", "i", "j").applyInArrow(_candidates(best), "a long, b long").distinct()
        return staged(pairs.join(compared, ["a", "b"], "left_anti"), "pairs")

    def blocks(self, mixed: DataFrame, turn: int | None = None) -> DataFrame:
        """Buckets that hold several components, in blocks (bucket, i, j): nodes outside the main component on the left, all on the
        right. A bucket of up to ``BLOCK`` nodes is one block, a larger one as many as its nodes on the left and right need to
        meet. With ``turn`` each node is on the left in one of its buckets only, another one each turn; nodes that share
        buckets choose the same ones, so that few buckets are laid out on the right."""
        outside = mixed.where("component <> main")
        if turn is not None:
            chosen = outside.groupBy("node").agg(F.min_by("bucket", F.xxhash64("bucket", F.lit(turn))).alias("bucket"))
            outside = outside.join(staged(chosen, "turn", self.size, 24), ["node", "bucket"], "left_semi")
            mixed = mixed.join(chosen.select("bucket").distinct(), "bucket", "left_semi")
        cuts = F.ceil(F.col("n") / BLOCK).cast("int")
        own, others = F.pmod(F.xxhash64("node"), cuts).cast("int"), F.explode(F.sequence(F.lit(0), cuts - 1))
        columns = ["bucket", "node", "component", "main", "size", "alone", "plain"]
        left = outside.select(own.alias("i"), others.alias("j"), *columns, F.lit(True).alias("left"))
        right = mixed.select(others.alias("i"), own.alias("j"), *columns, F.lit(False).alias("left"))
        wide = self.nodes.select("node", "bands").join(self.marks, "node")
        return staged(left.unionByName(right).join(wide, "node"), "blocks", 2 * self.n_members, 400)

    def mixed(self, component: DataFrame) -> DataFrame | None:
        """Members of buckets that hold several components, with the largest one and the number of members."""
        members = (
            self.members.alias("m")
            .join(component.alias("c"), F.col("m.node") == F.col("c.node"), "left")
            .select("m.*", F.coalesce("component", "m.node").alias("component"))
        )
        members = staged(members, "labelled", self.n_members, 72)
        sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        buckets = sizes.groupBy("bucket").agg(
            F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n")
        )
        buckets = staged(buckets.where("parts > 1").select("bucket", "main", "n"), "mixed", self.n_members)
        return None if buckets.isEmpty() else staged(members.join(buckets, "bucket"), "mixed-members", self.n_members, 80)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row a document: id, class_id, class_size (documents), thash and keep (of each class, its first)."""
    refuse_names(id_column, "class_id", "class_size", "thash", "keep", "text", "k", "node", "wordless", "bands", "signature")
    docs = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    key = F.xxhash64(id_column, F.coalesce("text", F.lit("")))
    rows = docs.select(id_column, text_hash().alias("thash"), key.alias("k"), "text").mapInArrow(
        sketches(id_column),
        f"`{id_column}` {kind}, thash long, k long, node long, wordless boolean, bands array<long>, signature binary",
    )
    rows = staged(rows, "sketches")
    component = _Search(docs, id_column, rows).links()
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("n"),
        F.min(id_column).alias("low_id"),
        F.min(F.struct(F.col(id_column).isNull().alias("none"), id_column, "thash")).alias("first"),
    )
    nodes = nodes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = staged(nodes, "classes", rows.count(), 96)
    heads = classes.groupBy("component").agg(
        F.sum("n").alias("class_size"), F.min("low_id").alias("class_id"), F.min("first").alias("head")
    )
    heads = staged(heads, "heads", rows.count(), 96)
    of_node = staged(classes.select("node", "component").join(heads, "component"), "of-node", rows.count(), 96)
    return rows.join(of_node, "node").select(
        id_column,
        "class_id",
        "class_size",
        "thash",
        (F.col(id_column).eqNullSafe(F.col(f"head.{id_column}")) & (F.col("thash") == F.col("head.thash"))).alias("keep"),
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without all but the first of each class; all columns stay."""
    classes = near_duplicates(docs, id_column, text_column)
    kept = staged(classes.where("keep").select(F.struct(F.col(id_column).alias("id"), "thash").alias("of")).distinct(), "kept")
    of = free_name(docs, "of")
    keyed = docs.withColumn(of, F.struct(F.col(id_column).alias("id"), text_hash(text_column).alias("thash")))
    on = F.col(f"d.{of}.id").eqNullSafe(F.col("k.of.id")) & (F.col(f"d.{of}.thash") == F.col("k.of.thash"))
    return keyed.alias("d").join(kept.alias("k"), on, "left_semi").dropDuplicates([of]).select(*[f"`{c}`" for c in docs.columns])


@register("op1_minhash_dedup")
def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")
