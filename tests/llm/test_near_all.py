"""Every pair of texts within the limit is linked, and no other."""

from __future__ import annotations

import random

from hyphalake.llm import simhash


def test_no_link_beside_the_limit_is_left_out(spark):
    rng = random.Random(31)
    word = lambda: "".join(rng.choices("abcdefghijk", k=rng.randint(3, 8)))
    texts = []
    for _ in range(120):  # families whose members lie on both sides of the limit
        base = [word() for _ in range(rng.randint(100, 200))]
        for _ in range(5):
            other = list(base)
            for at in rng.sample(range(len(base)), rng.randint(1, max(2, len(base) // 40))):
                other[at] = word()
            texts.append(" ".join(other))
    sets = [set(simhash.shingle_set(t).tolist()) for t in texts]
    up = list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for k in range(0, len(texts), 5):
        for a in range(k, k + 5):
            for b in range(a + 1, k + 5):
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    want = {k: root(k) for k in range(len(texts))}
    assert 200 < len(set(want.values())) < 550
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()} == want
