"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features say which n-grams a text has: single tokens and pairs (runs of letters and digits, runs of
other signs, case kept), and runs of one to three token shapes (case, digits, length class, the sign itself,
or a repeat of an earlier token) together with how often they occur in the text, in powers of two. They are
hashed to 2**18 places. Each indicator is scaled by its class log-count ratio; on rows of length one a
linear hinge-loss model is fitted by dual coordinate descent, and a fifth of the rows, left out of
that, turns its margins into probabilities.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled rows of least hash, taken from the
labels alone. Its texts are picked by a join against that sample, whose size is bounded, and
reach one task as sets of places. The fitted model is one number for each place (1 MB). All texts are
scored whole, without a shuffle.

Defined results: null text counts as empty; a text without features gets the score of its missing
evidence, the same for all. Labels of null quality or null id, or of documents that are not there, are not
used; a document labelled twice counts twice. Ids may be null or repeat; a null id is held out. Without
any label, or with labels of one class only, every score is that class's share (0.5 without labels).
Empty tables give empty results. Labels, source, language and id are no features.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, refuse_names, register, staged, table, text_hash, texts_of
from .words import BATCH_CHARS, batches, code_points, mix, pieces, run_hashes, word_classes, classes, SPACE

BITS = 18
SAMPLE = 20_000
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 15
THRESHOLD = 0.3
FOLDS = 5


@functools.cache
def upper() -> np.ndarray:
    table = np.zeros(len(classes()), dtype=bool)
    table[[p for p in range(0x20000) if unicodedata.category(chr(p)) in ("Lu", "Lt")]] = True
    return table


@functools.cache
def digit() -> np.ndarray:
    table = np.zeros(len(classes()), dtype=bool)
    table[[p for p in range(0x20000) if unicodedata.category(chr(p)) == "Nd"]] = True
    return table


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of each token, and bounds by text."""
    points, at = code_points(texts)
    inside, blank = word_classes()[points], classes()[points] == SPACE
    change = np.ones(len(points) + 1, dtype=bool)
    kind = inside.astype(np.int8) - blank
    change[1:-1] = kind[1:] != kind[:-1]
    change[at] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    solid = ~blank[starts] if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[solid], ends[solid]
    hashes = run_hashes(points, starts, ends)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[ends] - sums[starts]

    size = ends - starts
    caps, digits = count(upper()[points]), count(digit()[points])
    case = np.where(caps == 0, 0, np.where((caps == size) & (size > 1), 3, np.where((caps == 1) & upper()[points[starts]], 1, 2)))
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 5)
    word = 1000 + case * 100 + (digits > 0) * 10 + length
    shape = np.where(inside[starts], word, 100000 + points[starts].astype(np.int64) * 8 + np.minimum(size, 7))
    return hashes, shape, np.searchsorted(starts, at)


def _grams(values: np.ndarray, owner: np.ndarray, width: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` values that stay within an owner."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=owner.dtype)
    made = np.full(n, salt, dtype=np.uint64)
    for i in range(width):
        made = mix(made * np.uint64(0x9E3779B97F4A7C15) + values[i : i + n])
    same = owner[:n] == owner[width - 1 :]
    return made[same], owner[:n][same]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of each text in a row, and bounds by text."""
    if len(texts) == 1 and len(texts[0]) > 2 * BATCH_CHARS:
        parts = [_tokens([p]) for p in pieces(texts[0])]
        hashes, shape = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        at = np.array([0, len(hashes)])
    else:
        hashes, shape, at = _tokens(texts)
    total = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), total)
    found = [_grams(hashes, owner, width, width) for width in (1, 2)]
    # A token met before in its text has a shape of its own.
    key = (owner.astype(np.uint64) << np.uint64(52)) | (hashes >> np.uint64(12))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    near = np.zeros(len(hashes), dtype=bool)
    near[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    shape = (shape * 4 + again + 2 * near).astype(np.uint64)
    for width in (1, 2, 3):
        made, by = _grams(shape, owner, width, 10 + width)
        keys, kinds, times = _count(by, made)
        level = np.floor(np.log2(times / total[keys])).astype(np.int64)
        found.append((mix(kinds ^ level.astype(np.uint64)), keys))
    made = np.concatenate([f[0] for f in found])
    by = np.concatenate([f[1] for f in found])
    keys = np.unique((by.astype(np.uint64) << np.uint64(BITS)) | (mix(made) >> np.uint64(64 - BITS)))
    places = (keys & np.uint64((1 << BITS) - 1)).astype(np.int32)
    return places, np.searchsorted(keys >> np.uint64(BITS), np.arange(len(texts) + 1, dtype=np.uint64))


def _count(by: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) and how often each occurs; a batch has less than 2**12 owners."""
    keys = np.sort((by.astype(np.uint64) << np.uint64(52)) | (made >> np.uint64(12)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    keys = keys[at]
    return (keys >> np.uint64(52)).astype(np.int64), keys << np.uint64(12), np.diff(np.append(at, len(new)))


def ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) of each place, from smoothed counts of rows that have it."""
    counts = []
    for wanted in (good, ~good):
        places = [r for r, w in zip(rows, wanted) if w]
        c = SMOOTHING + np.bincount(np.concatenate(places) if places else np.zeros(0, dtype=int), minlength=1 << BITS)
        counts.append(c / c.sum())
    return np.log(counts[0] / counts[1])


def descend(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of least hinge loss, by dual coordinate descent over rows scaled to length one."""
    sign = np.where(good, 1.0, -1.0)
    scaled = [ratio[r] for r in rows]
    scaled = [x / max(np.sqrt((x * x).sum()), 1e-9) for x in scaled]
    # The offset is the weight of a place that every row has.
    weight, offset, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, places = scaled[i], rows[i]
            slope = sign[i] * (weight[places] @ x + offset) - 1
            new = min(max(alpha[i] - slope / 2.0, 0.0), COST)
            step = (new - alpha[i]) * sign[i]
            if step:
                weight[places] += step * x
                offset += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weight, offset


def margins(places: np.ndarray, at: np.ndarray, ratio: np.ndarray, weight: np.ndarray, offset: float) -> np.ndarray:
    scaled = ratio[places]
    upto = np.concatenate([[0.0], np.cumsum(scaled * weight[places])])
    norm = np.concatenate([[0.0], np.cumsum(scaled * scaled)])
    return (upto[at[1:]] - upto[at[:-1]]) / np.maximum(np.sqrt(np.maximum(norm[at[1:]] - norm[at[:-1]], 0)), 1e-9) + offset


def calibrate(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins and (smoothed) classes, by Newton's method."""
    n1, n0 = good.sum(), (~good).sum()
    goal = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - goal) * margin).sum() + 1e-3 * (a - 1), (p - goal).sum() + 1e-3 * b])
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fit(rows: list[np.ndarray], good: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[float, float, float]]:
    """Ratio and weight of each place; offset, slope and shift."""
    order = np.random.default_rng(3).permutation(len(rows))
    rest, main = order[: len(rows) // FOLDS], order[len(rows) // FOLDS :]
    if good[main].all() or not good[main].any():
        share = good.mean() if len(good) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        none = np.zeros(1 << BITS, dtype=np.float32)
        return none, none, (0.0, 1.0, float(np.log(share / (1 - share))))
    kept = [rows[i] for i in main]
    ratio = ratios(kept, good[main])
    weight, offset = descend(kept, good[main], ratio)
    if len(rest):
        at = np.cumsum([0, *(len(rows[i]) for i in rest)])
        slope, shift = calibrate(margins(np.concatenate([rows[i] for i in rest]), at, ratio, weight, offset), good[rest])
    else:
        slope, shift = 2.0, 0.0
    return ratio.astype(np.float32), weight.astype(np.float32), (float(offset), slope, shift)


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    sample: int = SAMPLE,
):
    """The fitted model: ratio, weight, (offset, slope, shift).

    It is fitted to at most ``sample`` rows: that many labels, the ones of least hash, each with one document of its id, the
    one whose text has the least hash.
    """
    usable = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")).where("id is not null and label is not null")
    chosen = usable.where(~held_out("id")).orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    # At most ``sample`` rows of two or three numbers: sides of a proven size.
    chosen = staged(chosen, "label-sample")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    labelled = texts.join(F.broadcast(chosen.select("id").distinct()), "id")
    least = labelled.groupBy("id").agg(F.min(text_hash()).alias("thash"))
    least = staged(least.join(chosen, "id"), "label-texts")
    picked = texts.join(F.broadcast(least), "id").where(text_hash() == F.col("thash")).select("id", "label", "text")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, packed = texts_of(batch), []
        for _, part in batches(texts):
            places, at = features(part)
            packed += [places[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        columns = [batch.column("id"), batch.column("label"), pa.array(packed, type=pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "label", "places"])

    kinds = [labels.schema[c].dataType.simpleString() for c in (id_column, label_column)]
    rows = picked.mapInArrow(per_batch(sets), f"id {kinds[0]}, label {kinds[1]}, places binary")
    # Copies of one text under one id are one row.
    rows = staged(rows.dropDuplicates(["id", "label"]), "label-sets")

    def learn(found: pa.Table) -> pa.Table:
        found = found.sort_by([("label", "ascending"), ("places", "ascending")])
        sets = [np.frombuffer(p, dtype=np.int32) for p in found["places"].to_pylist()]
        ratio, weight, rest = fit(sets, found["label"].to_numpy() > 0)
        return pa.table({"ratio": [ratio.tobytes()], "weight": [weight.tobytes()], "rest": [list(rest)]})

    made = rows.groupBy(F.lit(1).alias("all")).applyInArrow(
        lambda found: learn(found.select(["label", "places"])), "ratio binary, weight binary, rest array<double>"
    )
    model = made.first()
    if model is None:
        return fit([], np.zeros(0, dtype=bool))
    return np.frombuffer(model["ratio"], dtype=np.float32), np.frombuffer(model["weight"], dtype=np.float32), tuple(model["rest"])


def _scores(texts: list[str], model) -> np.ndarray:
    ratio, weight, (offset, slope, shift) = model
    parts = [np.zeros(0)]
    for _, part in batches(texts):
        places, at = features(part)
        margin = margins(places, at, ratio.astype(np.float64), weight.astype(np.float64), offset)
        parts.append(1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))))
    return np.concatenate(parts)


def quality_scores(docs: DataFrame, model, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted for each document."""
    refuse_names(id_column, "held_out", "score", "predicted", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(_scores(texts_of(batch), sent.value))], [id_column, "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    scored = docs.select(F.col(id_column), F.col(text_column).alias("text")).mapInArrow(per_batch(score), f"`{id_column}` {kind}, score double")
    return scored.select(id_column, held_out(id_column).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_low_quality(docs: DataFrame, model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents of a score of at least ``threshold``; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_scores(texts_of(batch, text_column), sent.value) >= threshold))

    return docs.mapInArrow(per_batch(keep), docs.schema)


@register("op8_quality")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
