"""MinHash near-duplicates against all pairs of full sets."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.conftest import DOCS

from hyphalake.llm import minhash

SCHEMA = "doc_id long, text string"


def words_of(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]


def plain_set(text, words=2):
    w = words_of(text)
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute(docs, words=2, limit=Fraction(4, 5)):
    sets = [plain_set(t, words) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and Fraction(len(a & b), len(a | b)) >= limit:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for k, (d, _) in enumerate(docs):
        r = find(k)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(d, low[r])
    return sorted([(d, len(s), low[find(k)], d == low[find(k)]) for k, ((d, _), s) in enumerate(zip(docs, sets))], key=str)


def family(rng, base, size, edits):
    """Texts that each differ from base in some words, of which few are shared."""
    out = []
    for _ in range(size):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.randint(*edits)):
            w[at] = rng.choice([f"own{rng.random()}", "common", "either"])
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        texts += family(rng, base, 25, (1, max(2, len(base) // 9)))
    texts += [" ".join(word() for _ in range(n)) for n in (1, 1, 2, 3, 4, 5) for _ in range(10)]
    short = [word() for _ in range(6)]  # exact quotients at the limit: 4 of 5, 8 of 10
    texts += [" ".join(short[:5]), " ".join(short), " ".join(short[1:]), "A", "a", "A a", "a\ta", " ".join(["x y"] * 50)]
    rng.shuffle(texts)
    return [(k * 3, t) for k, t in enumerate(texts)]


def test_links_equal_all_pairs(spark, docs):
    got = minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_cells_of_one_bucket_hold_all_its_pairs(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 3000)
    got = minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_a_chain_without_a_common_middle(spark):
    """Neighbours are within the limit and others are not, so no star alone finds the whole chain."""
    w = [f"w{k}" for k in range(400)]
    chain = [(900 - k, " ".join(w[3 * k : 3 * k + 60])) for k in range(100)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(chain, SCHEMA)).collect()}
    assert set(got.values()) == {801}


def test_prefix_filter_equals_all_pairs():
    rng = np.random.default_rng(4)
    for trial in range(60):
        base = rng.integers(0, 2**63, 60, dtype=np.uint64)
        sets = [np.unique(np.concatenate((rng.choice(base, rng.integers(20, 60), replace=False), rng.integers(0, 2**63, rng.integers(0, 9), dtype=np.uint64)))) for _ in range(30)]
        sides = rng.integers(0, 2, 30) if trial % 2 else np.zeros(30, np.int64)
        both = len(set(sides.tolist())) == 2
        pairs = [(i, j) for i in range(30) for j in range(i + 1, 30) if not (both and sides[i] == sides[j]) and 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 70 * (len(sets[i]) + len(sets[j]) - c)]

        def parts(edges):
            root = list(range(30))
            for i, j in edges:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
            return root

        assert parts(minhash.linked(sets, np.arange(30), sides, 70)) == parts(pairs)


@pytest.mark.parametrize("share", [0.8, 0.9])
def test_pairs_meet_in_bands(share):
    """Even small sets at the limit share a band."""
    rng = np.random.default_rng(2)
    bands = minhash.band_count(0.8, 6, 1e-6)
    for n in (5, 10, 40, 400):
        common, own = round(n * share), n - round(n * share)
        sets = []
        for _ in range(500):
            both = rng.integers(0, 2**63, common, dtype=np.uint64)
            sets += [np.concatenate((both, rng.integers(0, 2**63, own, dtype=np.uint64))), both]
        keys = minhash.band_keys(sets, bands, 6)
        assert (keys[::2] == keys[1::2]).any(axis=1).all()


def test_defined_cases(odd, none):
    got = sorted(map(tuple, minhash.near_duplicates(odd).collect()), key=str)
    assert got == brute([(d[0], d[1]) for d in DOCS])
    assert minhash.near_duplicates(none).collect() == []


def test_rows_without_key(spark):
    docs = [(None, "one two three four"), (None, "one two three four"), (7, "one two three four"), (None, "alone it stands"), (None, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {(None, 3, 7, False), (7, 3, 7, True), (None, 2, None, True), (None, 0, None, True)}
