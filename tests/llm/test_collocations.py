import random
import re
from collections import Counter

import pytest

from millrace.llm import collocations as C


def brute(rows, least, share, top):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t.,;:!?\n\x0b\x0c\r]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        heavy = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in heavy.items():
            inside = (q for q in heavy if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * heavy[q] >= share * a for q in inside):
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = own[p[:k]], own[p[k:]]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def sample(seed, texts, vocabulary=14):
    rng = random.Random(seed)
    words = [*(f"w{i}" for i in range(vocabulary)), "É", "The", "THE", "the", "a" * 80, "b" * 70 + "c"]
    fixed = "one two three four five six seven"
    rows = []
    for i in range(texts):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(fixed if rng.random() < 0.2 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "\t", ", ", "\n", " . ", "; ", "\r\n", "  "]))
        rows.append(("".join(parts), rng.choice(["en", "de", None, "", "und"])))
    return rows + [(None, "en"), ("", "fr"), (" .\n", "fr"), ("lone", "xx"), ("é é é é é é é é", "é")] + rows[:7]


def spread(spark, rows):
    frame = [(t, g, 1, 2, "p", "q") for t, g in rows]
    return spark.createDataFrame(frame, "text string, lang string, n long, w1 long, phrase string, word string").repartition(3)


@pytest.mark.parametrize("least, share, top", [(4, 80, 1000), (2, 60, 30), (30, 80, 2000)])
def test_phrases_equal_brute_force(spark, least, share, top):
    rows = sample(least, 300)
    found = C.collocations(spread(spark, rows), least, share, top).drop("path_words").collect()
    assert sorted(map(tuple, found)) == brute(rows, least, share, top)


def test_words_without_a_short_number_count_the_same(spark, monkeypatch):
    rows = sample(9, 200)
    monkeypatch.setattr(C, "MOST_WORDS", 5)
    found = C.collocations(spread(spark, rows), 3).drop("path_words").collect()
    assert sorted(map(tuple, found)) == brute(rows, 3, 80, 2000)


def test_sums_are_sent_in_parts(spark, monkeypatch):
    rows = sample(10, 200)
    docs = spread(spark, rows).repartition(1)
    monkeypatch.setattr(C, "HELD", 40)
    found = C.collocations(docs, 3).drop("path_words").collect()
    assert sorted(map(tuple, found)) == brute(rows, 3, 80, 2000)


def test_flows_do_not_depend_on_batches(spark):
    rows = sample(11, 200)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        found = C.collocations(spread(spark, rows), 3).drop("path_words").collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, found)) == brute(rows, 3, 80, 2000)


def test_unary_paths_are_compacted(spark):
    text = ". ".join(["a b c d e f g h"] * 5 + ["x b c d y"] * 3)
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    counts, names, _ = C.phrase_counts(docs, 3)
    word = {r.w: r.word for r in names.collect()}
    found = {}
    for r in C.paths(counts).collect():
        found.setdefault(" ".join(word[w] for w in r.head), []).append((r.place, " ".join(word[w] for w in (r.w1, r.w2, r.w3, r.w4))))
    # (b c d) joins two ways in and two ways out, so paths end there.
    assert {k: [e for _, e in sorted(v)] for k, v in found.items()} == {
        "a b c d": ["a b c d"], "x b c d": ["x b c d"], "b c d y": ["b c d y"],
        "b c d e": ["b c d e", "c d e f", "d e f g", "e f g h"],
    }


def test_a_text_longer_than_a_slice(spark):
    rng = random.Random(3)
    rows = [(" ".join(rng.choice(["red", "green", "blue", "x.", "and"]) for _ in range(300_000)), "en")]
    found = C.collocations(spark.createDataFrame(rows, "text string, lang string"), 30).drop("path_words").collect()
    assert sorted(map(tuple, found)) == brute(rows, 30, 80, 2000)


def test_nothing(nothing):
    assert C.collocations(nothing).count() == 0
