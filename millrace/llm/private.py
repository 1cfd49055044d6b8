"""Personal data: direct identifiers, and terms that give them away.

Base spans are e-mail addresses, IPv4 addresses, card and phone numbers, by fixed patterns and checks.
Each identifier is a protected entity. How strongly a term reveals one is told by the corpus: with
documents as events, the term's pointwise mutual information with the entity, as a share of the
entity's information content, is

    (log p(e|t) - log p(e)) / -log p(e)

where p(e|t) is the share of the term's documents in which the entity stands too, anywhere. Documents of equal
text count once, so that copies add no evidence. Little evidence counts less: p(e|t) is smoothed towards
p(e) by ``PRIOR`` documents, (n_et + PRIOR p(e)) / (n_t + PRIOR). Terms whose smoothed share is at least
``REVEALS`` are disclosing: wherever they stand outside identifiers, in documents without an identifier too, they
are spans of the kind "term". A single text is evidence enough in a corpus of some 90 texts or more (0.8 ** -20 texts).

``sanitised`` writes the result: identifiers give way to the name of their kind, fully disclosing terms
(a share of one before smoothing) are removed, others are generalised to [WORD], [NAME] (a capital first) or [NUMBER].

There are three passes over the texts. The first finds identifiers and the words of the texts that hold some. These
words go into a bitmap (32 MB at most), by which the second pass counts the texts of these words only; a word
that is counted without need changes nothing. Texts that may have copies, by a bitmap too, are shuffled by
their hash and counted once each; no other text is shuffled but by ``sanitised``. A term of an entity of n_e texts
stands in at most (n_e + PRIOR p(e)) / p(e) ** (1 - REVEALS) - PRIOR texts, else its share is too small whatever
the texts are; only pairs within that bound are made, and entities of the same texts are one, as their shares are
equal. The third pass finds the places of the disclosing words, by a sieve of three bitmaps and a join that settles it: with one, a few
frequent words that disclose nothing made most of the rows.

Defined results: null text counts as empty. Rows of equal id and equal text are the same document
and get the same spans. Ids may be null or repeat. Empty tables give empty results. Further columns
are not looked at, and stay in ``sanitised``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, may_have, sieve, sifted, wanted
from .common import free_name, per_batch, register, staged, table, text_hash, texts_of
from .words import BATCH_CHARS, batches, pieces, word_hashes, words

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
REVEALS = 0.95
PRIOR = 0.25

# Each pattern begins where a run begins, and never gives back: what it finds is what the plain
# pattern finds leftmost, in time that grows with the text only.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for found in DOMAIN.finditer(text):
        start = found.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < found.start():
            done = found.end()
            yield start, done


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end and the identifier as such, by kind and start."""
    out = []
    if "@" in text:
        out += [("email", a, b, text[a:b].lower()) for a, b in emails(text)]
    for found in IP.finditer(text):
        # A part of very many digits is too large whatever it is.
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in found.group().split(".")):
            out.append(("ip", *found.span(), found.group()))
    for found in CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *found.span(), digits))
    if "+" in text:
        for found in PHONE.finditer(text):
            digits = re.sub(r"[^0-9]", "", found.group())
            if 9 <= len(digits) <= 15:
                out.append(("phone", *found.span(), digits))
    return out


def spelled(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def entity_hash(kind: str, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def outside(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[str, int, int, str]]) -> np.ndarray:
    """Which words of a text stand outside all its identifiers."""
    free = np.ones(len(starts), dtype=bool)
    for _, start, end, _ in spans:
        free[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end)] = False
    return free


def placed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of the texts, by batch: number of the text, hash, and start and end in that text."""
    for first, batch in batches(texts):
        if len(batch) == 1 and len(batch[0]) > BATCH_CHARS:
            done = 0
            for piece in pieces(batch[0]):
                hashes, starts, ends, _ = words([piece])
                yield np.full(len(hashes), first), hashes, starts + done, ends + done
                done += len(piece)
        else:
            hashes, starts, ends, bounds = words(batch)
            owner = np.repeat(np.arange(len(batch)), np.diff(bounds))
            begins = np.cumsum([0] + [len(t) for t in batch])[owner]
            yield first + owner, hashes, starts - begins, ends - begins


def _scan(id_column: str):
    """Per document: base spans, the entities, and if there are any the words outside identifiers, each once."""

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = {k: [] for k in KINDS}
        digest, base, entities, terms = [], [], [], []
        for text in texts_of(batch):
            spans = base_spans(text)
            for kind in KINDS:
                counts[kind].append(sum(s[0] == kind for s in spans))
            base.append(spelled(spans))
            digest.append(hashlib.sha256(base[-1].encode()).hexdigest())
            entities.append(sorted({entity_hash(k, v) for k, _, _, v in spans}))
            found = [hashes[outside(a, b, spans)] for _, hashes, a, b in placed([text])] if spans else []
            terms.append(np.unique(np.concatenate(found)).view(np.int64) if found else [])
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(id_column),
                batch.column("thash"),
                *[pa.array(counts[k], type=pa.int64()) for k in KINDS],
                pa.array(digest),
                pa.array(base),
                pa.array(entities, type=longs),
                pa.array(terms, type=longs),
            ],
            [id_column, "thash", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "entities", "words"],
        )

    return per_batch(scan)


def _rare(bits: bytes):
    """A row for each word of a text whose slot is set."""

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column("words")
        owner, flat = pc.list_parent_indices(found).to_numpy(), found.flatten().to_numpy()
        mine = wanted(bits, flat)
        return pa.RecordBatch.from_arrays([batch.column("thash").take(pa.array(owner[mine])), pa.array(flat[mine])], ["thash", "t"])

    return per_batch(pick)


def _marker(id_column: str, bitmaps: list[bytes]):
    """Where words that pass the sieve stand outside identifiers, by document."""

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch)
        parts = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for found in placed(texts):
            mine = sifted(bitmaps, found[1])
            owner, hashes, starts, ends = (x[mine] for x in found)
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
            free = [outside(starts[a:b], ends[a:b], base_spans(texts[owner[a]])) for a, b in zip(edges[:-1], edges[1:])]
            if free:
                free = np.concatenate(free)
                parts.append((owner[free], hashes[free], starts[free], ends[free]))
        owner, hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
        at = pa.array(owner)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_column).take(at), batch.column("thash").take(at), pa.array(hashes.view(np.int64)), pa.array(starts), pa.array(ends)],
            ["did", "thash", "t", "a", "b"],
        )

    return per_batch(mark)


def _counter(bits: bytes, copied: bytes | None = None):
    """Texts of each word whose slot is set, by batch; without those that may have copies, if ``copied`` tells them."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        if copied is not None:
            batch = batch.filter(pa.array(~wanted(copied, batch.column("k").to_numpy())))
        parts = [np.zeros(0, dtype=np.uint64)]
        for _, hashes, bounds in word_hashes(texts_of(batch)):
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            mine = wanted(bits, hashes)
            owner, hashes = owner[mine], hashes[mine]
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            parts.append(hashes[new])
        keys, times = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times.astype(np.int64))], ["t", "n"])

    return per_batch(count)


class Findings:
    """Base spans by document, and the places of disclosing words."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reveals: float = REVEALS):
        kind = docs.schema[id_column].dataType.simpleString()
        self.id_column = id_column
        source = docs.select(F.col(id_column), text_hash(text_column).alias("thash"), F.col(text_column).alias("text"))
        self.base = staged(
            source.mapInArrow(
                _scan(id_column),
                f"`{id_column}` {kind}, thash long, "
                + ", ".join(f"n_{k} long" for k in KINDS)
                + ", base_sha256 string, base string, entities array<long>, words array<long>",
            ),
            "identifiers",
        )
        total = self.base.select("thash").distinct().count()
        held = self.base.where(F.size("entities") > 0)
        times = staged(self._times(source, held.select(F.explode("words").alias("t"))), "word-counts")
        # Entities of the same texts have the same shares: one stands for all of them.
        holds = held.select("thash", F.explode("entities").alias("e")).distinct()
        p_e = F.col("n_e") / F.lit(total)
        entities = staged(
            holds.groupBy("e")
            .agg(F.count("*").alias("n_e"), F.bit_xor("thash").alias("x"), F.bit_xor(F.xxhash64("thash")).alias("y"))
            .where(F.col("n_e") < total)
            .groupBy("n_e", "x", "y")
            .agg(F.min("e").alias("e"))
            .select("e", "n_e", ((F.col("n_e") + PRIOR * p_e) / F.pow(p_e, F.lit(1 - reveals)) - PRIOR + 1e-6).alias("most")),
            "entities",
        )
        rare = times.join(entities.agg(F.max("most").alias("most")), F.col("n_t") <= F.col("most")).select("t", "n_t")
        rare = staged(rare, "rare-words")
        near = held.select("thash", "words").mapInArrow(_rare(bitmap(rare.select("t"))), "thash long, t long").distinct()
        pairs = (
            near.join(rare, "t")
            .join(holds.join(entities, "e"), "thash")
            .where(F.col("n_t") <= F.col("most"))
            .groupBy("e", "t")
            .agg(F.count("*").alias("n_et"), F.max("n_t").alias("n_t"), F.max("n_e").alias("n_e"))
        )
        smooth = (F.col("n_et") + F.lit(PRIOR) * p_e) / (F.col("n_t") + F.lit(PRIOR))
        # Each word once, with the largest share of those it discloses.
        self.disclosing = staged(
            pairs.where((F.log(smooth) - F.log(p_e)) / -F.log(p_e) >= reveals - 1e-12)
            .groupBy("t")
            .agg(F.max((F.log(F.col("n_et") / F.col("n_t")) - F.log(p_e)) / -F.log(p_e)).alias("share")),
            "disclosing",
        )
        marks = source.mapInArrow(
            _marker(id_column, sieve(self.disclosing.select("t"))), f"did {kind}, thash long, t long, a long, b long"
        )
        self.terms = staged(
            marks.join(self.disclosing, "t")
            .groupBy("did", "thash")
            .agg(F.sort_array(F.collect_set(F.struct("a", "b", "share"))).alias("terms")),
            "terms",
        )

    def _times(self, source: DataFrame, keys: DataFrame) -> DataFrame:
        """For the words of ``keys``, and some more: the number of different texts they stand in."""
        bits = bitmap(keys)
        keyed = source.select(F.col("thash").alias("k"), "text")
        copies = self.base.groupBy("thash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("thash").alias("k"))
        copies = staged(copies, "copies")
        once = keyed.mapInArrow(_counter(bits, bitmap(copies)), "t long, n long")
        more = may_have(keyed, copies).dropDuplicates(["k"]).mapInArrow(_counter(bits), "t long, n long")
        return once.union(more).groupBy("t").agg(F.sum("n").alias("n_t"))

    def spans(self) -> DataFrame:
        """id, counts by kind, base_sha256, all spans, and n_term."""
        b, t = self.base.alias("b"), self.terms.alias("t")
        on = F.col(f"b.{self.id_column}").eqNullSafe(F.col("t.did")) & (F.col("b.thash") == F.col("t.thash"))
        added = F.transform(
            F.coalesce("t.terms", F.array().cast("array<struct<a:long,b:long,share:double>>")),
            lambda s: F.concat_ws(":", F.lit(TERM), s["a"], s["b"]),
        )
        parts = F.concat(F.when(F.col("b.base") != "", F.array("b.base")).otherwise(F.array().cast("array<string>")), added)
        return b.join(t, on, "left").select(
            f"b.{self.id_column}",
            *[f"b.n_{k}" for k in KINDS],
            "b.base_sha256",
            F.array_join(parts, ",").alias("spans"),
            F.size(added).cast("long").alias("n_term"),
        )


def rewritten(text: str, terms: list[tuple[int, int, float]]) -> str:
    """The text without identifiers and with disclosing terms removed or generalised."""
    cuts = [(start, end, f"[{kind.upper()}]") for kind, start, end, _ in base_spans(text)]
    for start, end, share in terms:
        word = text[start:end]
        name = "[NUMBER]" if word[:1].isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"
        cuts.append((start, end, "" if share >= 1 - 1e-9 else name))
    out, done = [], 0
    for start, end, name in sorted(cuts):
        # Identifiers of two kinds may overlap: the later goes on where the earlier ended.
        if end > done:
            out += [text[done : max(start, done)], name]
            done = end
    return "".join([*out, text[done:]])


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reveals: float = REVEALS) -> DataFrame:
    """The documents with personal data taken out of the text; all columns and rows stay."""
    terms = Findings(docs, id_column, text_column, reveals).terms
    thash, extra = free_name(docs, "thash"), free_name(docs, "terms")
    keyed = docs.withColumn(thash, text_hash(text_column))
    on = F.col(f"d.`{id_column}`").eqNullSafe(F.col("t.did")) & (F.col(f"d.{thash}") == F.col("t.thash"))
    joined = keyed.alias("d").join(terms.alias("t"), on, "left").select(*[f"d.`{c}`" for c in docs.columns], F.col("t.terms").alias(extra))

    def rewrite(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, found = batch.column(text_column).to_pylist(), batch.column(extra).to_pylist()
        new = [
            t and rewritten(t, [(s["a"], s["b"], s["share"]) for s in f or []])
            for t, f in zip(texts, found)
        ]
        kept = [c for c in batch.schema.names if c != extra]
        columns = [pa.array(new, type=batch.column(c).type) if c == text_column else batch.column(c) for c in kept]
        return pa.RecordBatch.from_arrays(columns, kept)

    return joined.mapInArrow(per_batch(rewrite), docs.schema)


@register("op5_private")
def op5(spark, sf_dir):
    return Findings(table(spark, sf_dir, "documents")).spans()
