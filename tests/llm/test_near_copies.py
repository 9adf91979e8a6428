"""Near copies against the exact Jaccard index of their shingles, and rows that share a key."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from hyphalake.llm import quality, simhash
from hyphalake.llm.common import Scratch, connected_components


def jaccard(a, b, words=5):
    x, y = (set(simhash.shingle_set(t, words).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


@pytest.fixture(scope="module")
def pairs():
    """Pairs of all similarities from 0.6 on, by edits at random places."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghijk", k=rng.randint(3, 8)))
    out = []
    for k in range(500):
        base = [word() for _ in range(rng.randint(60, 400))]
        edits = rng.randint(1, max(1, len(base) // 20))
        other = list(base)
        for at in rng.sample(range(len(base)), edits):
            other[at] = word()
        out.append((" ".join(base), " ".join(other)))
    return out


def test_links_follow_the_exact_index(spark, pairs):
    texts = [t for p in pairs for t in p]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    bands = defaultdict(list)
    for k, (a, b) in enumerate(pairs):
        bands[min(9, int(jaccard(a, b) * 20) - 10)].append(got[2 * k + 1] == 2 * k)
    assert not any(x for band, found in bands.items() if band < 6 for x in found)  # none below 0.8
    near = [x for band, found in bands.items() if band >= 6 for x in found]
    at_limit = bands[6]  # 0.80 to 0.85
    assert len(near) > 100 and len(at_limit) > 25
    assert sum(near) / len(near) >= 0.97 and sum(at_limit) / len(at_limit) >= 0.9


@pytest.mark.parametrize("group_rows", [40, 100_000])
def test_a_large_group_of_near_copies_is_one(spark, group_rows):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    texts = []
    for k in range(400):
        w = list(words)
        w[rng.randrange(300)] = f"edit{k}"
        texts.append((k, " ".join(w)))
    texts += [(1000 + k, " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(50))) for k in range(50)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, group_rows=group_rows).collect()}
    assert all(got[k] == 0 for k in range(400)) and all(got[1000 + k] == 1000 + k for k in range(50))
    assert simhash.without_near_copies(docs).count() == 51


def test_rows_that_share_a_key_are_judged_by_their_own_text(spark):
    rng = random.Random(6)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    a, b = text(100), text(100)
    docs = spark.createDataFrame([(1, a, "x"), (1, b, "x"), (1, a, "y"), (None, b, "z"), (None, None, None), (2, "", "e")], "doc_id long, text string, row string")
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted(["", a, b])
    junk = "|| ## $$ %% " * 60
    labels = spark.createDataFrame([(k, int(k < 50)) for k in range(100)], "doc_id long, quality int")
    rows = [(k, text(30).capitalize() + "." if k < 50 else junk + str(k), "en", "s") for k in range(100)] + [(500, text(30).capitalize() + ".", "en", "s"), (500, junk, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [r.text for r in quality.kept_documents(docs, labels).where("doc_id = 500").collect()]
    assert len(got) == 1 and got[0] != junk


def test_components_by_another_tag_do_not_meet(spark):
    scratch = Scratch(spark, "t")
    a = connected_components(spark.createDataFrame([(1, 2)], "a long, b long"), scratch)
    b = connected_components(spark.createDataFrame([(3, 4)], "a long, b long"), scratch, tag="other")
    assert {r.node for r in a.collect()} == {1, 2} and {r.node for r in b.collect()} == {3, 4}
