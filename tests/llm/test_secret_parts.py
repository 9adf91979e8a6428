"""Keys joined to an allowed word, and keys of lower-case letters and digits."""

from __future__ import annotations

from hyphalake.llm import secret_scan

KEY = "9fK3xQ7bT2mW8zR4vL6pY1nC5"


def test_keys_beside_allowed_words_are_found(spark):
    texts = [f"sample_x={KEY}", f"/example/{KEY}", f"{KEY}{KEY[::-1]}dummy{KEY}", "x k3v9q7x2m8w4z6r1t5y0 y", "exampleWord1Sample2Dummy3Example", "123e4567-e89b-12d3-a456-426614174000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans} for r in secret_scan.find_secrets(docs).collect()}
    assert all(any(KEY in x for _, x in got[k]) for k in (0, 1, 2))
    assert {k for k, _ in got[3]} == {"entropy_lower"} and not got[4] and not got[5]
