import re

import numpy as np
import pytest

from millrace.llm import words as W


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_words_are_runs_of_letters_and_digits(corpus):
    texts = [t or "" for _, t in corpus] + ["a,b c", "É-è ñ", "x" * 50, " lead", "a1 1a"]
    for first, hashes, bounds in W.word_hashes(texts):
        names = {}
        for i in range(len(bounds) - 1):
            found = plain_words(texts[first + i])
            assert bounds[i + 1] - bounds[i] == len(found)
            for word, value in zip(found, hashes[bounds[i] : bounds[i + 1]]):
                assert names.setdefault(word, value) == value
        assert len(set(names.values())) == len(names)


def test_a_long_text_is_cut_between_words():
    text = "word other " * 150_000
    (first, hashes, bounds), = W.word_hashes([text])
    assert first == 0 and bounds.tolist() == [0, 300_000] and len(np.unique(hashes)) == 2


def test_shingles_by_width():
    _, hashes, bounds = next(W.word_hashes(["a b c d e f", "a b c", "", "b c d e f"]))
    found, at = W.shingles(hashes, bounds, 5)
    assert np.diff(at).tolist() == [2, 1, 0, 1]
    assert found[1] == found[3] and len(np.unique(found)) == 3


def test_no_text_at_all():
    assert list(W.word_hashes([])) == []
    _, hashes, bounds = next(W.word_hashes([""]))
    assert len(hashes) == 0 and bounds.tolist() == [0, 0]


def thue_morse(size):
    row = [0]
    while len(row) < size:
        row += [1 - x for x in row]
    return "".join("ab"[x] for x in row), "".join("ba"[x] for x in row)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_strings_that_no_polynomial_tells_apart(size):
    _, hashes, _ = next(W.word_hashes([*thue_morse(size)]))
    assert len(np.unique(hashes)) == 2
