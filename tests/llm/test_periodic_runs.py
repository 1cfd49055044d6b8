import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import periodic_runs as P


def brute_runs(words):
    """(start, length, period) by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1) if j > i else i + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def answer(doc, text):
    words = re.findall("[^ \t-\r]+", text or "")
    n, h = len(words), 1 if doc is None else zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = None if not runs else 1000 * best[1] // best[2]
    return (doc, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def texts():
    rng = random.Random(4)
    out = ["", None, " \n", "one", "a a a a a", "a a a a a a", "é é é é é é\té\x0bé b", "a b " * 3, "a b " * 4 + "a", "a\x85b " * 9]
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 12)):
            unit = [rng.choice("abcdé") for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 31, 62]))]
            words += (unit * rng.choice([1, 2, 4, 5, 7]))[: rng.choice([5, 40, 300])]
            words += [rng.choice("xyz") for _ in range(rng.randrange(4))]
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
    out += ["ab " * 3000, ("ab " * 40 + "c ") * 12, " ".join(f"w{i % 97}" for i in range(2000)), out[20], out[20]]
    return out


def test_results_equal_brute_force(spark, monkeypatch):
    rows = list(enumerate(texts())) + [(None, "b b b b b b b"), (None, None), (3, "b b b b b b b")]
    rows = [(i, t) for i, t in rows] + [(1000 + i, t) for i, t in rows if i]
    frame = spark.createDataFrame([(i, t, 1, "r", "c") for i, t in rows], "doc_id long, text string, n_words long, runs string, start string")
    monkeypatch.setattr(P, "table", lambda *a: frame.repartition(3))
    found = P.op12(spark, "").collect()
    assert sorted(map(tuple, found), key=str) == sorted((answer(*r) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(0, 1 + seed, rng.integers(0, 400)) for _ in range(20)]
    parts += [np.tile(rng.integers(0, 3, k), 6) for k in (1, 2, 30, 31, 32, 70)]
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    got = list(zip(*(x.tolist() for x in P.runs_of(np.concatenate(parts), cuts))))
    assert got == [(t, *r) for t, p in enumerate(parts) for r in brute_runs(p.tolist())]


@pytest.mark.parametrize("kind", ["random", "copies", "one", "square"])
def test_extensions_equal_comparison(kind):
    rng = np.random.default_rng(7)
    body = {
        "random": rng.integers(0, 2, 700), "copies": np.tile(rng.integers(0, 9, 250), 3),
        "one": np.zeros(500, dtype=np.int64), "square": np.tile(np.repeat([0, 1], 40), 7),
    }[kind]
    ids = np.append(body, 99)
    i, j = rng.integers(0, len(body), (2, 3000))
    i, j = i[i != j], j[i != j]
    more = P.equal_ahead(np.append(ids, -1 - np.arange(5)), i, j, len(ids) - np.maximum(i, j))
    assert (P.Extensions(ids)(i, j) == more).all()


def test_grid_pairs_are_cut_into_parts(monkeypatch):
    ids = np.tile(np.arange(5), 60)
    whole = P.runs_of(ids, np.array([0, 200, 300]))
    monkeypatch.setattr(P, "PAIRS", 3)
    for a, b in zip(whole, P.runs_of(ids, np.array([0, 200, 300]))):
        assert a.tolist() == b.tolist()


def test_cover_has_every_difference():
    assert {(b - a) % P.MODULUS for a in P.COVER for b in P.COVER} == set(range(P.MODULUS))


def test_a_text_longer_than_a_slice(spark):
    text = " ".join(f"word{i % 70_000}" for i in range(300_000))
    (row,) = P.without_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 70_000)]
    assert row.collapsed == " ".join(f"word{i}" for i in range(70_000))


def test_nothing(nothing):
    assert P.without_runs(nothing).count() == 0


def test_a_result_name_is_no_id(nothing):
    with pytest.raises(ValueError):
        P.without_runs(nothing.withColumnRenamed("doc_id", "runs"), "runs")
