import re

import pytest

from millrace.llm import decontaminate as D


def shingle_set(text, width):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def contained(item, text):
    n = min(5, len(re.findall(r"[^\W_]+", (item or "").lower())))
    if not n:
        return None
    want = shingle_set(item, n)
    got = want & shingle_set(text, n)
    return (len(got), len(want)) if len(got) >= 0.8 * len(want) else None


@pytest.fixture(scope="module")
def items(corpus):
    by_id = {i: t for i, t in corpus if i is not None}
    long = max((t for t in by_id.values() if t), key=len)
    return [
        (1, by_id[72]), (2, " ".join(by_id[73].split()[28:110])), (3, "w1x w2x"), (4, by_id[5]), (5, ""), (6, None),
        (7, "???"), (None, " ".join(by_id[74].split()[35:90])), (1, by_id[72]), (8, "not there at all in any text"), (9, long),
        (10, " ".join(by_id[75].split()[40:60] + ["other", "end"])), (11, "Ö"),
    ]


@pytest.mark.parametrize("block", [D.BLOCK, 20])
def test_pairs_equal_brute_force(spark, documents, corpus, items, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK", block)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.contained_items(documents, benchmark).collect()
    want = [(i, n, *c) for i, t in corpus for n, x in items if (c := contained(x, t or ""))]
    assert sorted([(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found], key=str) == sorted(want, key=str)
    assert all(r.containment == r.n_shared / r.n_item for r in found)
    kept = D.drop_contaminated(documents, benchmark)
    clean = [i for i, t in corpus if not any(contained(x, t or "") for _, x in items)]
    assert kept.columns == documents.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted(clean, key=str)


def test_a_short_item_in_a_very_long_text(spark):
    long = " ".join(f"n{i}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long, 5), (2, "n5 n6", 5)], "doc_id long, text string, item_id long")
    benchmark = spark.createDataFrame([(1, " ".join(f"N{i}" for i in range(150_000, 150_040)))], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.contained_items(docs, benchmark).collect()] == [(1, 1)]


def test_empty_tables(spark, nothing, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.contained_items(documents, none).count() == 0
    assert D.contained_items(nothing, one).count() == 0
    assert D.drop_contaminated(documents, none).count() == documents.count()


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "date", "decimal(5,1)"])
def test_ids_of_items_of_any_type(spark, kind):
    frame = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id long, text string")
    value = "DATE '2024-01-02'" if kind == "date" else "7"
    items = frame.selectExpr(f"CAST({value} AS {kind}) AS item_id", "text")
    (row,) = D.contained_items(frame, items).collect()
    assert str(row.item_id) in ("7", "7.0", "2024-01-02") and row.containment == 1
    with pytest.raises(ValueError):
        D.contained_items(frame.withColumnRenamed("doc_id", "item_id"), items, "item_id")
