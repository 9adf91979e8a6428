"""The Merkle manifest against a plain version, and its defined cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hyphalake.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r: tuple) -> str:
    doc_id, text, lang, source, n_chars = r
    return _h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def _up(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of a run of nodes, and each one's steps (left, right)."""
    paths, now, at = [[] for _ in hashes], hashes, list(range(len(hashes)))
    while len(now) > 1:
        for p, k in zip(paths, at):
            first = k // 8 * 8
            p.append(("".join(now[first:k]), "".join(now[k + 1 : first + 8])))
        now, at = [_h(*now[k : k + 8]) for k in range(0, len(now), 8)], [k // 8 for k in at]
    return now[0], paths


def _lower(s: str | None) -> str | None:
    return s if s is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _brute(rows: list[tuple]) -> list[tuple]:
    groups = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r))) for g in groups}
    subs = {g: _up([_leaf(r) for r in members[g]]) for g in groups}
    root, above = _up([subs[g][0] for g in groups])
    out = []
    for g, rest in zip(groups, above):
        for r, own in zip(members[g], subs[g][1]):
            path = own + rest
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = _leaf((r[0], _lower(r[1]), *r[2:])) if changed else _leaf(r)
            for left, right in path:
                now = _h(left, now, right)
            out.append((r[0], _leaf(r), subs[g][0], root, _h(*[a + b for a, b in path]), now, now == root))
    return sorted(out, key=str)


def _rows(n: int, langs: list) -> list[tuple]:
    return [(k * 7 % n, None if k % 11 == 0 else f"Text É {k % 5} " + "Ab " * (k % 40), langs[k % len(langs)], None if k % 13 == 0 else f"s{k % 3}", None if k % 17 == 0 else k) for k in range(n)]


@pytest.mark.parametrize("langs", [["en", None, "de", "", "é", "z"], [f"l{k}" for k in range(75)]])
@pytest.mark.parametrize("n", [1, 9, 600])
def test_merkle_equals_plain_version(spark, n, langs):
    rows = _rows(n, langs)
    got = merkle.tamper_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows)


def test_merkle_repeated_and_null_keys(spark):
    rows = [(None, "A", "en", None, 1), (None, "B", "en", None, 1), (3, "Same", "en", "s", 4), (3, "Same", "en", "s", 4), (3, "Other", "en", "s", 5), (5, "", "en", "s", 0), (9, "X" * 300_000, None, "s", 300_000)] + [(3, "Same", "en", "s", 4)] * 40
    got = merkle.tamper_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows)


def test_merkle_empty_table_and_other_columns(spark):
    assert merkle.tamper_report(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = _rows(30, ["en", "de"])
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in ("tree", "pos", "n", "hash", "item", "path", "row", "leaf", "key")])
    assert sorted(map(tuple, merkle.tamper_report(wide).collect()), key=str) == _brute(rows)


def test_merkle_folds_only_what_was_not_altered(spark):
    rows = spark.createDataFrame(_rows(200, ["en", "de"]), SCHEMA)
    for r in merkle.tamper_report(rows.withColumn("text", F.concat(F.lit("UP"), F.coalesce("text", F.lit(""))))).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0)
