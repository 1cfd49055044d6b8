import math
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import backoff as B


def brute(rows, order):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for _, t in rows]
    counts = Counter(g for w in words for n in range(1, order + 1) for g in zip(*[w[k:] for k in range(n)]))
    total = sum(map(len, words))

    def score(history, word):
        if not history:
            return counts[(word,)] / total
        if counts[(*history, word)] >= B.MIN_COUNT:
            return counts[(*history, word)] / counts[history]
        return B.ALPHA * score(history[1:], word)

    return [
        (doc, len(w), sum(math.log(score(tuple(w[max(0, i - order + 1) : i]), w[i])) for i in range(len(w))))
        for (doc, _), w in zip(rows, words)
    ]


@pytest.mark.parametrize(("order", "chunk"), [(3, B.CHUNK), (2, 300), (1, 300)])
def test_scores_equal_brute_force(spark, corpus, monkeypatch, order, chunk):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus], "doc_id long, text string, chunk long, data string")
    found = B.backoff_scores(frame.repartition(2), order=order).collect()
    want = brute(corpus, order)
    assert sorted([(r.doc_id, r.n_words, round(r.log_score, 6)) for r in found], key=str) == sorted(
        [(d, n, round(s, 6)) for d, n, s in want], key=str
    )
    assert all((r.score is None) == (r.n_words == 0) for r in found)


def test_packing_of_numbers():
    numbers = np.array([0, 1, 2**56 - 1, 5], dtype=np.uint64)
    assert B.unpacked(B.packed(numbers)).tolist() == numbers.tolist()
    assert B.unpacked(B.packed(numbers[:0])).tolist() == []


def test_totals_are_taken_by_place():
    """A chunk's n-grams are sorted once; their totals are then found without looking hashes up."""
    grams, bounds = B.n_grams(["a b a b", "", "b"], 2)
    keys, which = B.placed(grams)
    assert len(keys) == 4 and len(which) == 5 + 3
    totals = np.zeros(4, dtype=np.uint64)
    np.add.at(totals, which, 1)
    want = [math.log(2 / 5), 0.0, math.log(2 / 3), 0.0, math.log(3 / 5)]
    # "b a" occurs once only: back off to a.
    want[1], want[2], want[3] = math.log(2 / 2), math.log(B.ALPHA * 2 / 5), math.log(2 / 2)
    assert B.log_scores(grams, which, totals, 5) == pytest.approx(want)


def test_nothing(nothing):
    assert B.backoff_scores(nothing).count() == 0
