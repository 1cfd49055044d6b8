import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import fm_index as X
from millrace.llm import repeated_passages as R


def brute(rows, length=R.LENGTH):
    texts = [re.findall("[^ \t-\r]+", t or "") for _, t in rows]
    seen = Counter(tuple(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[tuple(t[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = " ".join(w for w, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)

    def noise(n, kinds=3000):
        return [f"é{rng.randrange(kinds)}" for _ in range(n)]

    shared, short = noise(120), noise(34)
    rows = [noise(rng.randrange(60)) + shared[a:b] + noise(rng.randrange(60)) for a, b in ((0, 120), (0, 35), (40, 90), (85, 120), (0, 34), (10, 45))]
    rows += [noise(20) + short + noise(20) for _ in range(4)]
    # One passage, and after it words of few kinds, so that some windows across its end meet.
    rows += [noise(5) + shared[:50] + noise(20, 3) for _ in range(25)]
    rows += [shared + shared, ["a"] * 100, ["a"] * 34, ["a"] * 35, ["a", "b"] * 40, noise(400), noise(2000, 2)]
    rows += [rows[0][3:-3], list(rows[1])]
    rows[-1][20] = "edited"
    out = [rng.choice([" ", "\n", "\t ", "\x0b"]).join(r) for r in rows] + ["", None, " \n"]
    return [*enumerate(out), (3, out[3]), (None, out[0]), (None, None)]


def spread(spark, rows):
    frame = [(i, t, 1, "g", "r", 2) for i, t in rows]
    return spark.createDataFrame(frame, "doc_id long, text string, k long, g string, ranges string, n_words long").repartition(3)


def answers(spark, monkeypatch, rows):
    monkeypatch.setattr(R, "table", lambda *a: spread(spark, rows))
    return sorted(map(tuple, R.op13(spark, "").collect()), key=str)


def test_removed_words_equal_brute_force(spark, monkeypatch, texts):
    assert answers(spark, monkeypatch, texts) == sorted(brute(texts), key=str)


def test_anchors_of_very_many_segments(spark, monkeypatch, texts):
    monkeypatch.setattr(R, "MOST_KINDS", 3)
    assert answers(spark, monkeypatch, texts) == sorted(brute(texts), key=str)


def test_small_shards(spark, monkeypatch, texts):
    monkeypatch.setattr(R, "SHARD_WORDS", 150)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert answers(spark, monkeypatch, texts) == sorted(brute(texts), key=str)
    finally:
        spark.conf.set(key, before)


def test_a_text_longer_than_a_slice(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"word{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[70_000:70_200], "y"])), (3, " ".join(words[-40:]))]
    assert answers(spark, monkeypatch, rows) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("kinds", [1, 2, 5, 300])
def test_index_equals_search(kinds):
    rng = np.random.default_rng(kinds)
    parts = [rng.integers(1, kinds + 1, rng.integers(0, 60)) for _ in range(40)]
    parts += parts[:5]
    ids = np.concatenate([np.append(p, 0) for p in parts])
    weights = np.repeat(rng.integers(1, 3, len(parts)), [len(p) + 1 for p in parts])
    index = X.FMIndex(ids, weights)
    tree = X.WaveletTree(ids, kinds + 1)
    symbol, at = rng.integers(0, kinds + 1, 500), rng.integers(0, len(ids) + 1, 500)
    assert tree.rank(symbol, at[None, :])[0].tolist() == [int((ids[:a] == c).sum()) for c, a in zip(symbol, at)]

    def weight(pattern):
        return sum(weights[i] for i in range(len(ids) - len(pattern) + 1) if (ids[i : i + len(pattern)] == pattern).all())

    ends = rng.choice(np.flatnonzero(ids), 60) + 1
    zeros = np.flatnonzero(ids == 0)
    most = np.array([min(e - max((z + 1 for z in zeros if z < e), default=0), 9) for e in ends])
    for least in (1, 2, 4):
        for e, m, got in zip(ends, most, index.match_lengths(ids, ends, most, least)):
            assert got == max((k for k in range(1, m + 1) if weight(ids[e - k : e]) >= least), default=0)


def test_the_code_is_compressed():
    row = np.repeat(np.arange(1, 9), [1000, 300, 100, 50, 20, 10, 5, 1])
    tree = X.WaveletTree(row, 9)
    share = np.bincount(row) / len(row)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    assert entropy <= (tree.lengths[row]).mean() <= entropy + 1


def test_nothing(nothing):
    assert R.without_passages(nothing).count() == 0


def test_a_result_name_is_no_id(nothing):
    with pytest.raises(ValueError):
        R.without_passages(nothing.withColumnRenamed("doc_id", "kept"), "kept")
