import random
import zlib

import numpy as np
import pytest

from millrace.llm import packing, token_counts, tokens

PATH = token_counts.default_tokenizer()


def thue_morse(size):
    row = [0]
    while len(row) < size:
        row += [1 - x for x in row]
    return "".join("ab"[x] for x in row), "".join("ba"[x] for x in row)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(3)
    alphabet = "ab 's'll're'x \n\t  .,!?'12é世界²½　 ᲀ don'tthey'vewe'll''s '"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    return made + ["", "<|endoftext|>", "a<|endoftext|> b", "\n\n\n", " " * 40 + "a", "it's I'll 's 'S O'Re 'llx", "'", "''s"]


def test_ids_equal_the_library(library, corpus):
    texts = odd_texts() + [t or "" for _, t in corpus]
    encoder, seen = tokens.tokens(PATH, tokens.not_whole(PATH)), 0
    for first, ids, bounds in encoder.encode(texts):
        for i in range(len(bounds) - 1):
            want = library.encode(texts[first + i], add_special_tokens=False).ids
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want, repr(texts[first + i])
            seen += 1
    assert seen == len(texts)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_strings_that_no_polynomial_tells_apart(spark, library, size):
    texts = thue_morse(size)
    found = token_counts.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), PATH)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [r.n_tokens for r in found.orderBy("doc_id").collect()] == [len(ids) for ids in want]
    (_, ids, bounds), = tokens.tokens(PATH, tokens.not_whole(PATH)).encode(list(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_long_texts_are_cut_where_a_token_begins(library, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_CHARS", 500)
    text = " ".join(odd_texts()[:300]).replace("<|endoftext|>", "") + "x" * 700 + " " * 700
    text = "".join(c for c in text if c.isascii())
    found = list(tokens.tokens(PATH, frozenset()).encode([text]))
    assert np.concatenate([f[1] for f in found]).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_files_go_through_the_library():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(path), ["Some words, and MORE.", "", "a  b"]
    (_, ids, bounds), = tokens.Tokens(path, frozenset()).encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("frame", ["documents", "clashing"])
def test_counts(request, corpus, library, frame):
    found = token_counts.token_counts(request.getfixturevalue(frame), PATH).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in corpus]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in found], key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)


@pytest.mark.parametrize("open_windows", [packing.OPEN, 3])
def test_every_id_lies_in_one_piece(spark, corpus, library, monkeypatch, open_windows):
    monkeypatch.setattr(packing, "OPEN", open_windows)
    rows = [(i, t, 5) for i, (_, t) in enumerate(corpus)] + [(1000, "many words here " * 3000, 5)]
    # One task: patched settings hold in this process only, so the operator's parts are run here.
    packer = packing.Packer(1024, 0)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows}
    for i in ids:
        packer.add(i, np.array(ids[i], dtype="<u4"))
    packer.flush()
    check_pieces([(d, s, len(x) // 4, zlib.crc32(x), len(ids[d]), q, o) for d, s, x, q, o in packer.out], ids, 1)
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(2), PATH)
    check_pieces([tuple(r) for r in found.collect()], ids, 2)


def check_pieces(pieces, ids, tasks):
    held, fill = {}, {}
    for doc, start, length, crc, total, sequence, offset in pieces:
        part = ids[doc][start : start + length]
        assert length == len(part) > 0 and total == len(ids[doc])
        assert crc == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        held.setdefault(doc, []).append((start, length))
        fill.setdefault(sequence, []).append((offset, length))
    for parts, size in [*((v, len(ids[d])) for d, v in held.items()), *((v, None) for v in fill.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size or size is None and at <= 1024
    assert set(held) == set(ids)
    assert sum(sum(n for _, n in v) < 1024 for v in fill.values()) <= tasks


def test_the_level_of_least_sum_of_squares():
    rng = random.Random(9)
    packer = packing.Packer(16, 0)
    for _ in range(300):
        packer.levels[:] = [0, *[rng.choice([0, 0, 1, 2, 5]) for _ in range(15)], 0]
        size = rng.randrange(1, 17)

        def cost(level):
            n = packer.levels.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            return int((n * n).sum())

        options = [0, *[h for h in range(1, 16) if packer.levels[h] and h + size <= 16]]
        best = min(cost(h) for h in options)
        assert packer.level_for(size) == max(h for h in options if cost(h) == best)


def test_nothing(nothing):
    assert token_counts.token_counts(nothing, PATH).count() == 0
    assert packing.pack(nothing, PATH).count() == 0
