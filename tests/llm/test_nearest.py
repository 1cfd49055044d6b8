import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import nearest as N


def brute(rows, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in {(i, tuple(x)) for i, x in usable if i is not None and i % 20 == 0}:
        found = [(-float(np.dot(x, v)), i is None, i or 0) for i, x in usable if i != q and len(x) == len(v)]
        out += [(q, r + 1, None if n else i, -s) for r, (s, n, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("blocks", [(N.ROW_BLOCK, N.QUERY_BLOCK), (70, 4)])
def test_neighbours_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(N, "QUERY_BLOCK", blocks[1])
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 24))
    vectors = np.round(centres[rng.integers(0, 12, 300)] + 0.3 * rng.normal(size=(300, 24)), 3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    # Ties, copies, other lengths, a null id, and vectors that take no part.
    rows += [(500 + i, rows[7][1]) for i in range(30)] + [(None, rows[9][1]), (20, rows[20][1])]
    rows += [(600, None), (601, [0.0] * 24), (602, [float("nan")] * 24), (603, [None] * 24), (604, []), (620, [float("inf")] * 24)]
    rows += [(640, [1.0, 2.0]), (641, [3.0, 4.0]), (660, [0.5, 0.5])]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, code int, score double")
    found = [tuple(r) for r in N.nearest(frame.repartition(3), F.expr("vec_id % 20 = 0")).collect()]
    want = brute(rows, N.NEAREST)
    assert sorted(f[:2] for f in found) == sorted(w[:2] for w in want)
    best = {w[:2]: w[2:] for w in want}
    right = sum(best[f[:2]][0] == f[2] for f in found)
    assert right >= 0.98 * len(found)
    assert all(abs(best[f[:2]][1] - f[3]) < 1e-9 for f in found if best[f[:2]][0] == f[2])


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    rows, queries = rng.normal(size=(2000, 64)), rng.normal(size=(20, 64))
    mean = rows.mean(axis=0)
    middle, off = N.bounds(*N.encoded(rows, mean), rows, mean, queries)
    error = middle - queries @ rows.T
    assert abs((error / off * N.EPSILON).mean()) < 0.02
    assert (np.abs(error) <= off).mean() > 0.95


def test_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.nearest(none, F.expr("vec_id % 20 = 0")).count() == 0
    odd = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert N.nearest(odd, F.expr("vec_id % 20 = 0")).count() == 0
    alone = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert N.nearest(alone, F.expr("vec_id % 20 = 0")).count() == 0
