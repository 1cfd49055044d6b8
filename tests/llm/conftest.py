import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns beyond those the operators name, some with names that operators give to their own.
CLASHING = "doc_id long, text string, k long, node long, g long, ranges string, class_id string, score string, thash string"


def sentence(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, empty and very short ones: (id, text)."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.choice([3, 4, 5, 8, 30, 60, 90, 200])) for _ in range(60)]
    for i in range(12):
        words = texts[40 + i].split()
        for _ in range(1 + i % 3):
            words[rng.randrange(len(words))] = f"edit{i}"
        texts.append(" ".join(words))
    passage = sentence(rng, 70, 10_000)
    texts += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 40) for _ in range(6)]
    texts += [texts[0], texts[0].upper(), texts[9] + "!", "", None, "...", "!!!", "!!!", "Ä ö", "ab ab ab " * 200]
    return list(enumerate(texts)) + [(None, texts[3]), (None, None), (7, texts[7])]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in corpus]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, corpus):
    rows = [(i, t, 1, 1, 1, "r", "c", "s", "h") for i, t in corpus]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
