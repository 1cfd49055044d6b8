import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import private as P

PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and P.luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
}


def plain_spans(text):
    return [(k, *m.span()) for k, (p, good) in PLAIN.items() for m in re.finditer(p, text) if good(m.group())]


@pytest.mark.parametrize("alphabet", ["a@.-b 1", "0123456789 -", "+1 ().-0", "1.25 .6", "@a.b%+-", "é@a.b٣1"])
def test_spans_equal_the_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert [s[:3] for s in P.base_spans(text)] == plain_spans(text)


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 500_000 + "@", "1" * 500_000, "1." * 250_000, "+" * 500_000, "@a" * 200_000, "9" * 300_000 + ".1.1.1"):
        P.base_spans(text)


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(8)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(50)}" for _ in range(60)]
        if i % 8 == 0:
            words[10:10] = ["mail", "jo@ex.org", "Zebra"]
        elif i % 8 == 1:
            words[30:30] = ["call", "+49 30 1234567", "lion", "77x"]
        rows.append((i, " ".join(words)))
    # A word near the same entity in two texts, one of them twice, and one that a single text accuses.
    rows += [(50, rows[0][1] + " only"), (50, rows[0][1] + " only"), (None, None), (51, ""), (None, "jo@ex.org alone")]
    return rows


def brute_terms(rows, reveals):
    """Places of disclosing words in each row, by counts over different texts, whole documents and smoothed shares."""

    def outside(text):
        spans = P.base_spans(text)
        found = [(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W_]+", text)]
        return {(k, v) for k, _, _, v in spans}, [w for w in found if not any(w[1] < e and w[2] > s for _, s, e, _ in spans)], {w for w, _, _ in found}

    texts = {t or "": outside(t or "") for _, t in rows}
    n_e, n_t, n_et = Counter(), Counter(), Counter()
    for entities, words, whole in texts.values():
        n_e.update(entities)
        n_t.update(whole)
        n_et.update({(e, w) for e in entities for w, _, _ in words})
    disclosing = set()
    for (e, w), n in n_et.items():
        p = n_e[e] / len(texts)
        if p < 1:
            smooth = (n + P.PRIOR * p) / (n_t[w] + P.PRIOR)
            if (math.log(smooth) - math.log(p)) / -math.log(p) >= reveals - 1e-12:
                disclosing.add(w)
    return [sorted((a, b) for w, a, b in texts[t or ""][1] if w in disclosing) for _, t in rows]


@pytest.mark.parametrize("which", ["letters", "single", "many"])
def test_spans_and_terms_equal_brute_force(spark, request, which):
    rows = many_texts() if which == "many" else request.getfixturevalue(which)
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, e string, t long, near string")
    terms = brute_terms(rows, P.REVEALS)
    want = []
    for i, (doc, text) in enumerate(rows):
        base = [f"{k}:{a}:{b}" for k, a, b, _ in P.base_spans(text or "")]
        counts = [sum(s.startswith(k) for s in base) for k in P.KINDS]
        digest = hashlib.sha256(",".join(base).encode()).hexdigest()
        want.append((doc, *counts, digest, ",".join(base + [f"term:{a}:{b}" for a, b in terms[i]])))
    found = P.Findings(frame).spans().drop("n_term").collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert which == "letters" or any("term" in w[-1] for w in want)


def many_texts():
    """Identifiers of one, some and many texts, with words that go with them always, mostly or by chance; copies among them."""
    rng = random.Random(21)
    rows = []
    for i in range(600):
        words = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(3, 40))]
        who = rng.randrange(30)
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), f"p{who}@ex.org")
            words.append(f"Friend{who}")
            words += [f"pal{who}"] * (rng.random() < 0.8)
        elif i % 7 == 0:
            words += [f"pal{who}", f"friend{who}" if i % 2 else "and"]
        rows.append((i, " ".join(words)))
    return rows + [(600 + i, rows[rng.randrange(600)][1]) for i in range(80)] + [(None, None), (5, ""), (10, rows[10][1])]


def test_sanitised_texts(spark, letters):
    frame = spark.createDataFrame([(i, t, 7) for i, t in letters], "doc_id long, text string, n long")
    found = P.sanitised(frame)
    assert found.columns == frame.columns
    rows = {r.doc_id: r.text for r in found.collect()}
    assert found.count() == len(letters) and all(r.n == 7 for r in found.collect())
    assert "jo@ex.org" not in str(rows.values()) and "[EMAIL]" in rows[0] and "[PHONE]" in rows[1] and "Zebra" not in rows[0]
    assert rows[2] == letters[2][1] and rows[51] == "" and None in [r.text for r in found.collect()]


@pytest.fixture(scope="module")
def single():
    """An identifier of one text only, in 400 texts; copies of texts, and a word that is as rare but stands elsewhere."""
    rows = [(i, f"common words of text n{i % 7} m{i % 11} and k{i % 13} z{i}") for i in range(400)]
    rows[5] = (5, "common words Zebulon writes from jo@ex.org and k5 rare")
    rows[6] = (6, "common words and rare")
    # Copies of the second text of a word are one text: it stands in two, not in 31.
    return rows + [(5, rows[5][1])] + [(400 + i, rows[5][1]) for i in range(30)] + [(None, rows[6][1])]


def test_an_identifier_of_a_single_text_has_disclosing_terms(spark, single):
    found = {(r.doc_id, r.spans, r.n_term) for r in P.Findings(spark.createDataFrame(single, "doc_id long, text string")).spans().collect()}
    text = single[5][1]
    marked = {text[int(a) : int(b)] for i, s, _ in found if i == 5 for k, a, b in (p.split(":") for p in s.split(",")) if k == "term"}
    assert marked == {"Zebulon", "writes", "from"}
    assert {n for i, _, n in found if i == 5 or (i or 0) >= 400} == {3} and {n for i, _, n in found if i is None or i in (6, 7)} == {0}


def test_disclosing_words_are_marked_wherever_they_stand(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{filler} v{i % 3}") for i in range(3000)]
    rows[1] = (1, f"jo@ex.org Zebra {filler} Zebra {filler} Far")
    rows[2] = (2, f"jo@ex.org {filler} far and a zebra, zebra@ex.org")
    rows = [(i, t if i in (1, 2) else f"{t} u{i}") for i, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in P.Findings(frame).spans().where("n_term > 0").collect()}
    marked = {
        i: [rows[i][1][int(a) : int(b)] for k, a, b in (p.split(":") for p in s.split(",")) if k == "term"] for i, s in spans.items()
    }
    assert {1, 2} <= set(marked) and marked[1] == ["Zebra", "Zebra", "Far"] and marked[2] == ["far", "and", "a", "zebra"]
    clean = {r.doc_id: r.text for r in P.sanitised(frame).collect()}
    assert "Zebra" not in clean[1] and "Far" not in clean[1]


def test_a_disclosing_word_is_marked_in_a_document_without_the_identifier(spark):
    rows = [(i, f"plain text u{i}") for i in range(3000)]
    rows[:9] = [(i, f"jo@ex.org Zebra u{i}") for i in range(9)]
    rows[9] = (9, "plain text with Zebra u9")
    spans = {r.doc_id: r.spans for r in P.Findings(spark.createDataFrame(rows, "doc_id long, text string")).spans().collect()}
    assert spans[9] == "term:16:21" and spans[10] == ""


def test_words_of_long_texts_are_placed(monkeypatch):
    text = "one two jo@ex.org " * 20 + "end"
    monkeypatch.setattr(P, "pieces", lambda t: [t[:18], t[18:]])
    monkeypatch.setattr(P, "BATCH_CHARS", 100)
    found = [(int(i), text[a:b]) for owner, _, starts, ends in P.placed([text]) for i, a, b in zip(owner, starts, ends)]
    assert found == [(0, m.group()) for m in re.finditer(r"[^\W_]+", text)]


def test_overlapping_identifiers_are_all_taken_out():
    text = "x 1.2.3.4111111111111111 y +1 234 567 8901@a.b z"
    clean = P.rewritten(text, [(0, 1, 1.0), (25, 26, 0.97)])
    assert not P.base_spans(clean) and "[WORD]" in clean


def test_nothing(nothing):
    assert P.Findings(nothing).spans().count() == 0 and P.sanitised(nothing).count() == 0


def test_columns_of_any_name_stay(spark):
    frame = spark.createDataFrame([(1, "write to a@b.com", "x", 2)], "doc_id long, text string, __terms string, __thash long")
    assert [tuple(r) for r in P.sanitised(frame).collect()] == [(1, "write to [EMAIL]", "x", 2)]
    frame = spark.createDataFrame([(1, "write to a@b.com", "x", 2)], "doc_id long, text string, terms string, thash long")
    assert [tuple(r) for r in P.sanitised(frame).collect()] == [(1, "write to [EMAIL]", "x", 2)]


def test_frequent_words_that_disclose_nothing_are_not_carried(spark):
    """The marking pass hands on few words but the disclosing ones, however many stand in the texts."""
    from millrace.llm.bitmap import sieve, sifted
    from millrace.llm.words import mix

    keys = mix(np.arange(60_000, dtype=np.uint64))
    told = [(int(k),) for k in keys[:20_000].view(np.int64)]
    bitmaps = sieve(spark.createDataFrame(told, "t long"))
    passed = sifted(bitmaps, keys)
    assert set(range(20_000)) <= set(passed.tolist())
    assert len(passed) < 20_000 + 40
