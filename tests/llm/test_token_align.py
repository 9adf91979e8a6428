"""Token alignment against whole-text encoding by both libraries and a plain count of pairs."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.conftest import DOCS

from hyphalake.llm import token_align
from hyphalake.llm.bpe import byte_letters
from hyphalake.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), {c: k for k, c in enumerate(byte_letters())}


def plain_groups(libraries, text):
    """Groups of one text as lists of ids, cut where both have a token's end."""
    a, b, back = libraries
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(back[c] for c in a.id_to_token(k)) for k in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
    data = (" " + text).encode()
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return []
    out, i, j, x, y = [], 0, 0, 0, 0
    while i < len(ids_a):
        i0, j0 = i, j
        x, i = x + len(bytes_a[i]), i + 1
        while x != y:
            if x < y:
                x, i = x + len(bytes_a[i]), i + 1
            else:
                y, j = y + len(bytes_b[j]), j + 1
        out.append((ids_a[i0:i], ids_b[j0:j]))
    return out


def brute(libraries, docs):
    every = [(k, plain_groups(libraries, t)) for k, t in docs]
    per = [Counter(pair for ga, gb in g for pair in ((p, q) for p in ga for q in gb)) for _, g in every]
    count = Counter(p for c in per for p in c)
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for (k, g), c in zip(every, per):
        said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        figures = sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items())
        out.append((k, *figures, hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str), {(p, q, n, n == best[p]) for (p, q), n in count.items()}


ALPHABETS = ["abcde ", "Aa Éß'st 09²\n", " \t\n\r  ", "日本語かな ", "🙂‍👩🏽é̂ ", "AAAA", "x▁ y", "don't we'll 3.14 -- ", "\x00\x1b\x85﻿ ", "ñáçüœ ¿¡ "]


def made(n, seed=3):
    rng = random.Random(seed)
    return [(k, "".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.choice([1, 3, 30, 300])))) for k in range(n)]


@pytest.mark.parametrize("block_chars", [500, 4_000_000])
def test_align_equals_whole_encoding(spark, libraries, small, block_chars):
    docs = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()] + [(10_000 + k, t) for k, t in made(400)] + [(d[0], d[1]) for d in DOCS] + [(50_000, "<|endoftext|> and <s> </s> <unk> <0x41>"), (50_001, "7" * 3000 + "  " * 999), (50_002, "Q" * 20_001)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    rows, counts = token_align.align(frame, A, B, block_chars=block_chars)
    want, pairs = brute(libraries, docs)
    assert sorted(map(tuple, rows.collect()), key=str) == want
    assert set(map(tuple, counts.collect())) == pairs


def test_align_defined_cases(odd, none):
    rows, counts = token_align.align(odd, A, B)
    got = rows.collect()
    assert len(got) == len(DOCS)
    assert [tuple(r) for r in got if r.doc_id == 3] == [(3, 0, 0, 0, 0, 0, 0, "")]
    assert len({tuple(r) for r in got if r.doc_id in (9,)}) == 1 and any(r.doc_id is None and r.n_a for r in got)
    rows, counts = token_align.align(none, A, B)
    assert rows.collect() == [] and counts.collect() == []


def test_a_table_of_words_that_fills_up(spark, libraries, monkeypatch):
    monkeypatch.setattr(token_align, "EXPANDED", 3)
    docs = made(60, seed=9)
    codec = token_align.PairCodec(open(A, "rb").read(), open(B, "rb").read())
    for _, t in docs:
        if t:
            a, b, whole = codec.words(t)
            found = token_align.aligned_block(codec, [a if whole else a[:0]], [b if whole else b[:0]])
            g = plain_groups(libraries, t)
            assert int(found["n_groups"][0]) == len(g)
            per = Counter(p << 16 | q for ga, gb in g for p in ga for q in gb)
            assert dict(zip(found["pair"].tolist(), found["weight"].tolist())) == per
        codec.a.empty()
        codec.b.empty()


def test_groups_do_not_hash_or_search_byte_ends(monkeypatch):
    """Ends are counted by byte: the groups are those that cuts searched one by one give."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(token_align.np, "union1d", lambda *a: (_ for _ in ()).throw(AssertionError("ends are hashed")))
    for _ in range(50):
        ends = np.sort(rng.choice(np.arange(1, 60), 12, replace=False))
        a, b = (np.diff(np.append(np.sort(rng.choice(ends[:-1], k, replace=False)), 60), prepend=0) for k in (7, 5))
        of_a, of_b = token_align.groups(a, b)
        both = sorted(set(np.cumsum(a).tolist()) & set(np.cumsum(b).tolist()))
        assert of_a.tolist() == np.searchsorted(both, np.cumsum(a)).tolist() and of_b.tolist() == np.searchsorted(both, np.cumsum(b)).tolist()
    assert [x.tolist() for x in token_align.groups(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [[], []]


def test_groups_are_cut_without_components():
    """Groups are cut at common ends, which are counted once: no rounds over edges, whose number grows with the tokens."""
    assert not hasattr(token_align, "union")
    of_a, of_b = token_align.groups(np.array([2, 3, 1, 4]), np.array([5, 1, 2, 2]))
    assert (of_a.tolist(), of_b.tolist()) == ([0, 0, 1, 2], [0, 1, 2, 2])
