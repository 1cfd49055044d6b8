import hashlib
import random
from collections import Counter

import pytest

from millrace.llm import repeats as R


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    shared, other = noise(900), noise(399)
    rows = [noise(300) + shared[a:b] + noise(200) for a, b in ((0, 900), (0, 400), (100, 700), (450, 900), (0, 399), (300, 702))]
    rows += [noise(50) + other + noise(50) for _ in range(3)]
    rows += [shared + shared, "a" * 1500, "ab " * 400, "ab " * 100, noise(5000), noise(399), "", None]
    edited = list(rows[0])
    for i in range(0, len(edited), 500):
        edited[i] = "#"
    rows += ["".join(edited), rows[0][5:-5], rows[13]]
    out = list(enumerate(rows)) + [(13, rows[13]), (None, rows[9]), (None, None)]
    return out


def test_removed_bytes_equal_brute_force(spark, texts):
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in texts], "doc_id long, text string, k long, g long, ranges string")
    found = R.without_repeats(frame.repartition(3)).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(texts, R.LENGTH), key=str)


def test_long_texts_are_cut_into_blocks_that_overlap():
    rng = random.Random(2)
    text = bytes(rng.randrange(256) for _ in range(R.BLOCK + 5000))
    found = []
    for names, parts in R.blocks([text]):
        part, anchor, low, high, _, _ = R.anchors(parts)
        found += [(names[p][1] + a, names[p][1] + x, names[p][1] + y) for p, a, x, y in zip(part, anchor, low, high)]
    starts = sorted(s for _, x, y in found for s in range(x, y + 1))
    assert starts == list(range(len(text) - R.LENGTH + 1))
    assert all(x <= a <= x + R.OFFSETS - 1 + (y - x) and a <= y + R.OFFSETS - 1 and a >= y for a, x, y in found)


def test_a_text_longer_than_a_block(spark):
    rng = random.Random(9)
    words = [f"{rng.randrange(10**9)}" for _ in range(130_000)]
    text = " ".join(words)
    rows = [(1, text), (2, "x" + text[700_000:701_500] + "y"), (3, text[-450:])]
    found = R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, R.LENGTH))


def test_nothing(nothing):
    assert R.without_repeats(nothing).count() == 0
