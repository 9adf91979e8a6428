from __future__ import annotations

import pytest

LONG = "long words here and there " * 20_000
DOCS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, "The quick  brown fox jumps over\tthe lazy dog", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \n\t ", "de", "b"),
    (6, "ÀÉ naïve straße İstanbul ﬁ 日本語 👩‍👩‍👧 it's 12½ <|endoftext|> x<|startoftext|>", "fr", "b"),
    (7, LONG, "en", "a"),
    (8, "password = hunter2hunter2 and token: 0123456789abcdef0123456789abcdef", "en", "c"),
    (9, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (9, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (None, "a row without key", "en", "c"),
    (11, "one\ntwo\nthree\nfour lines of text that go on", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and clashing column names."""
    rows = [(*r, "x", 1, 2) for r in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size string, fp int, block int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
