"""Likeness of versions on either side of the length below which a text is taken by words."""

from __future__ import annotations

import pytest
from test_llm_operators import BLANK, Counter, likeness, paragraphs, rows

from hyphalake.llm.queries import QUERIES


def words(x):
    return Counter(p for p in BLANK.split(x) if p)


def test_pairs_across_the_limit_share_one_unit(spark, small):
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    order, across = sorted(texts, reverse=True), 0
    got = {r["doc_id"]: r for r in rows(QUERIES["op9_iblt"](spark, "/root/testdata/sf0.001"))}
    for i, k in enumerate(order):
        x, n = texts[k], texts[order[(i + 1) % len(order)]]
        cut = len(x) // 3
        for name, y in (("edited", x[: len(x) - cut] + n[:cut]), ("next", n)):
            unit = words if (len(x) < 400) != (len(y) < 400) else paragraphs
            across += unit is words
            a, b = unit(x), unit(y)
            assert got[k][f"near_{name}"] == pytest.approx(likeness(a, b))
            assert got[k][f"{name}_differ"] == sum(((a - b) + (b - a)).values())
            if name == "edited" and unit is words:
                assert got[k]["near_edited"] > 0.3
    assert across > 20
