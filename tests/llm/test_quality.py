import random
import zlib

import numpy as np
import pytest

from millrace.llm import quality as Q


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(rng.randrange(5, 80))]
        good = i % 3 > 0
        if not good:
            words = [w + rng.choice(["!!", "***", "$$$"]) if rng.random() < 0.5 else w for w in words] if i % 2 else words[:1] * len(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    rows += [(1000, ""), (1001, None), (None, "some text"), (3, "again"), (1002, "long words here " * 150_000)]
    labels += [(5, None, 1), (None, 1, 0), (99_999, 1, 0)]
    return rows, labels


def test_held_out_rows_are_told_apart(spark, labelled):
    rows, labels = labelled
    docs = spark.createDataFrame([(i, t, "a", 1.0) for i, t in rows], "doc_id long, text string, label string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.train(docs, marks)
    found = Q.quality_scores(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    for r in found:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    truth = {i: q for i, q, _ in labels if i is not None and q is not None}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    scores = {r.score for r in found if r.doc_id in (1000, 1001)}
    assert len(scores) == 1
    kept = Q.drop_low_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in found)


def test_labels_of_one_class_or_none(spark, nothing, labelled):
    docs = spark.createDataFrame(labelled[0][:20], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.quality_scores(docs, Q.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in Q.quality_scores(docs, Q.train(docs, one)).collect())
    assert Q.quality_scores(nothing, Q.train(nothing, one)).count() == 0


def test_descent_reaches_the_least_hinge_loss():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 6)).astype(np.int32) for _ in range(60)]
    good = np.array([(r < 20).sum() > len(r) / 2 for r in rows])
    ratio = np.ones(1 << Q.BITS)

    def loss(w, b):
        total = (w * w).sum() / 2 + b * b / 2
        for r, g in zip(rows, good):
            total += max(0, 1 - (1 if g else -1) * (w[r].sum() / np.sqrt(len(r)) + b))
        return total

    weight, offset = Q.descend(rows, good, ratio)
    best = loss(weight, offset)
    for _ in range(200):
        step = np.zeros_like(weight)
        step[:40] = rng.normal(0, 0.05, 40)
        assert loss(weight + step, offset + rng.normal(0, 0.05)) > best - 0.02


def test_log_count_ratios():
    rows = [np.array([0, 1]), np.array([1]), np.array([2])]
    ratio = Q.ratios(rows, np.array([True, True, False]))
    p, q = np.ones(1 << Q.BITS), np.ones(1 << Q.BITS)
    p[[0, 1]] += [1, 2]
    q[2] += 1
    assert np.allclose(ratio, np.log((p / p.sum()) / (q / q.sum())))


def test_the_fit_is_bounded_whatever_repeats(spark, monkeypatch):
    rows = [(i, f"good words number {i} here" if i % 2 else f"bad spam {i} !!!") for i in range(60)]
    docs = spark.createDataFrame(rows + [(1, f"other text {j}") for j in range(300)] + [rows[7]] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1)], "doc_id long, quality int")
    seen = []
    whole = Q.staged

    def spy(frame, label, *more):
        made = whole(frame, label, *more)
        if label == "label-sets":
            seen.append(made.count())
        return made

    monkeypatch.setattr(Q, "staged", spy)
    Q.train(docs, labels)
    Q.train(docs, labels, sample=20)
    assert seen[0] <= 60 and 10 < seen[1] <= 20
