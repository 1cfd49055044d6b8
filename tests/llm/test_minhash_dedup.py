import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import minhash_dedup as M


def shingle_counts(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[k] / a[d], b[k] / b[d]) for k in keys) for d in a if d in b)


def brute_classes(rows):
    counts = [shingle_counts(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") if not counts[i] and not counts[j] else False
            if same or (counts[i] and counts[j] and similarity(counts[i], counts[j]) >= 0.8):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return groups.values()


def expected(rows):
    out = []
    for group in brute_classes(rows):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], min(ids, default=None), len(group)) for i in group]
    return sorted(out, key=str)


def test_classes_equal_brute_force(clashing, corpus):
    found = M.near_duplicates(clashing).collect()
    assert sorted([(r.doc_id, r.class_id, r.class_size) for r in found], key=str) == expected(corpus)


def test_one_document_of_each_class_stays(documents, corpus):
    kept = M.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len(list(brute_classes(corpus)))


def test_nothing_gives_nothing(nothing):
    assert M.drop_near_duplicates(nothing).count() == 0


def test_probability_jaccard_equals_its_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = {int(k): int(w) for k, w in zip(rng.choice(30, 12, False), rng.integers(1, 5, 12))}
        b = {int(k): int(w) for k, w in zip(rng.choice(30, 15, False), rng.integers(1, 5, 15))}
        got = M.probability_jaccard(*[(np.array(sorted(x)), np.array([x[k] for k in sorted(x)])) for x in (a, b)])
        assert got == pytest.approx(similarity(Counter(a), Counter(b)))


def test_signatures_estimate_the_probability_jaccard():
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 2**52, 300).astype(np.uint64)
    ids = np.sort(np.unique(ids))
    a, b = rng.integers(1, 4, len(ids)), rng.integers(1, 4, len(ids))
    agree = []
    for shift in range(40):
        own = np.sort(M.mix(ids + np.uint64(shift)) & M.ID_MASK)
        owner = np.repeat([0, 1], len(own))
        signature = M.signatures(owner, np.concatenate([own, own]), np.concatenate([a, b]), 2)
        agree.append((signature[0] == signature[1]).mean())
    true = M.probability_jaccard((ids, a), (ids, b))
    assert np.mean(agree) == pytest.approx(true, abs=0.03)


def family(seed, copies):
    """Copies of one text with some of 120 words put in place of others, from few words a place: similar at 0.5 to 1."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(copies):
        words = list(base)
        for place in rng.sample(range(0, 120, 5), rng.randrange(8)):
            words[place] = f"e{place}x{rng.randrange(3)}"
        out.append((i, " ".join(words)))
    return out


def fast_classes(rows):
    sets = [set(shingle_counts(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8 - 1e-9:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("centres", [M.CENTRES, 1])
def test_a_family_of_near_copies(spark, monkeypatch, centres):
    """Hundreds of texts that share buckets, some linked and some not quite: a large class and many small ones."""
    monkeypatch.setattr(M, "CENTRES", centres)
    rows = family(1, 300)
    want = fast_classes(rows)
    assert max(map(len, want)) > 100 and len(want) > 20
    found = {}
    for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in found.values()} == want


def test_parities_bound_the_difference():
    rng = np.random.default_rng(4)
    sets = [Counter(rng.integers(0, 300, rng.integers(1, 200)).tolist()) for _ in range(30)]
    owner = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
    ids = np.concatenate([np.array(sorted(s), dtype=np.uint64) for s in sets])
    weight = np.concatenate([[s[k] for k in sorted(s)] for s in sets])
    marks = M.parities(owner, ids, weight, len(sets)).view(np.uint64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = sum(abs(a[k] - b[k]) for k in set(a) | set(b))
            assert np.bitwise_count(marks[i] ^ marks[j]).sum() <= apart
            if similarity(a, b) >= 0.8:
                assert apart <= 0.4 * min(a.total(), b.total()) + abs(a.total() - b.total()) + 1e-6


def test_bounds_of_weights_let_similar_pairs_pass_and_few_others():
    """One side has repeated shingles: pairs of 0.8 or more pass, those that differ in three tenths of their shingles do not."""
    rng = np.random.default_rng(5)
    sides, sets, pairs = [], [], []
    for i in range(80):
        ids = set(range(200)) - set(rng.choice(200, rng.integers(0, 60), False).tolist())
        ids |= set(range(1000 + 200 * i, 1000 + 200 * i + int(rng.integers(0, 40))))
        found = Counter({k: int(1 + (rng.random() < 0.05) * rng.integers(1, 4)) for k in ids})
        sets.append(found)
        keys, w = np.array(sorted(found), dtype=np.uint64), np.array([found[k] for k in sorted(found)])
        pairs.append((keys, w))
        marks = M.parities(np.zeros(len(keys), dtype=np.int64), keys, np.ones_like(w), 1).view(np.uint64)
        sides.append((w.sum(), (w == 1).all(), marks))
    whole = {"size": np.array([s[0] for s in sides]), "plain": np.array([s[1] for s in sides]), "alone": np.zeros(80, dtype=np.int64), "marks": np.concatenate([s[2] for s in sides])}
    good, _ = M.may_be_similar(whole, whole)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if M.probability_jaccard(pairs[i], pairs[j]) >= 0.8:
                assert good[i, j]
            elif len(a.keys() ^ b.keys()) > 0.3 * max(a.total(), b.total()):
                assert not good[i, j]


def test_buckets_of_a_turn_are_shared(spark):
    """Nodes that lie in the same buckets meet in one of them in a turn, not each in another."""
    search = M._Search.__new__(M._Search)
    search.size, search.n_members = 50, 400
    search.nodes = spark.range(50).selectExpr("id AS node", "array(1L) AS bands")
    search.marks = spark.range(50).selectExpr("id AS node", "array(0L) AS marks")
    mixed = spark.range(50).selectExpr("id AS node", "id AS component", "99L AS main", "50L AS n", "1L AS size", "0L AS alone", "true AS plain", "explode(sequence(1L, 8L)) AS bucket")
    blocks = search.blocks(mixed, 0)
    assert blocks.select("bucket").distinct().count() == 1 and blocks.where("left").count() == 50 == blocks.where("not left").count()


def test_buckets_of_the_same_nodes_count_once(spark, monkeypatch):
    """Two alike texts share many buckets and are members of one."""
    made, staged = {}, M.staged

    def noted(df, label, *more):
        found = staged(df, label, *more)
        made.setdefault(label, found.count())
        return found

    monkeypatch.setattr(M, "staged", noted)
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(f"v{rng.randrange(10**6)}" for _ in range(300))]
    found = M.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id) for r in found} == {(0, 0), (1, 0), (2, 2)}
    assert made["crowded"] == 1 and made["met"] == 2 == made["banded"]


def test_families_that_meet_in_many_buckets(spark, monkeypatch):
    """Chains of near copies, each close to the next ones only: all links are found with rounds and without any."""
    rng = random.Random(21)
    rows = []
    for family in range(4):
        words = [f"f{family}w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(14):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    want = sorted(sorted(group) for group in brute_classes(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (1, 10**9):
        monkeypatch.setattr(M, "ROUND_SHARE", share)
        groups = {}
        for r in M.near_duplicates(frame).collect():
            groups.setdefault(r.class_id, []).append(r.doc_id)
        assert sorted(map(sorted, groups.values())) == want


def test_long_words_that_no_polynomial_tells_apart(spark):
    row = [0]
    while len(row) < 2048:
        row += [1 - x for x in row]
    texts = [" ".join(["".join(two[x] for x in row)] * 6) for two in ("ab", "ba")]
    found = M.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_size) for r in found} == {(0, 1), (1, 1)}


def test_texts_longer_than_a_batch(spark):
    rng = random.Random(8)
    words = [f"word{rng.randrange(10**6)}" for _ in range(150_000)]
    near, other = list(words), words[::-1]
    near[1000:1500] = ["x"] * 500
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((words, near, other))], "doc_id long, text string")
    assert {(r.doc_id, r.class_id) for r in M.near_duplicates(frame).collect()} == {(0, 0), (1, 0), (2, 2)}


def test_columns_of_any_name_stay(spark):
    frame = spark.createDataFrame([(1, "a b c", "x", 7, "y"), (2, "a b c", "z", 8, "u")], "doc_id long, text string, of string, __thash long, __id string")
    assert [tuple(r) for r in M.drop_near_duplicates(frame).collect()] == [(1, "a b c", "x", 7, "y")]
    with pytest.raises(ValueError):
        M.near_duplicates(frame.withColumnRenamed("doc_id", "class_id"), "class_id")
