"""Repeated passages against all runs of words: true ends, and what stays."""

from __future__ import annotations

import random
import re
from collections import Counter

from hyphalake.llm import cdc


def brute(texts, n):
    """Covered [start, end) of every text: unions of the runs of n words that occur twice."""
    seen, runs = Counter(), {}
    for k, x in texts.items():
        w = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", x)]
        runs[k] = [(w[i][0], w[i + n - 1][1]) for i in range(len(w) - n + 1)]
        seen.update(x[a:b] for a, b in runs[k])
    out = {}
    for k, x in texts.items():
        out[k] = []
        for a, b in runs[k]:
            if seen[x[a:b]] > 1:
                if out[k] and a < out[k][-1][1]:
                    out[k][-1] = (out[k][-1][0], b)
                else:
                    out[k].append((a, b))
    return out


def test_passages_are_found_with_their_true_ends(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijé", k=rng.randint(3, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    texts = {}
    for k in range(300):
        passage = some(45 + k % 30)
        texts[2 * k], texts[2 * k + 1] = f"{some(rng.randint(0, 60))} {passage}\n{some(30)}", f"{some(rng.randint(0, 60))}\t{passage} {some(30)}"
    texts[1001] = texts[0]
    texts[1002] = some(30) + " " + texts[5] + " " + texts[7]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = brute(texts, 50)
    got = {r["doc_id"]: [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x] for r in cdc.passage_report(docs).collect()}
    found = sum(bool(got[k]) for k in wanted if wanted[k])
    assert sum(map(bool, wanted.values())) > 450 and found >= 0.99 * sum(map(bool, wanted.values()))
    assert not any(got[k] for k in wanted if not wanted[k])
    # Ends agree but for words that also stand beside the passage by chance, and for copies told by their cuts.
    same = sum(got[k] == wanted[k] for k in wanted if k < 600)
    assert same >= 0.97 * 600
    # What stays still holds each passage once.
    clean = {r["doc_id"]: r["text"] for r in cdc.without_repeats(docs).collect()}
    whole = "\0".join(clean.values())
    kept = [texts[k][a:b] in whole for k, v in wanted.items() if k < 600 for a, b in v]
    assert sum(kept) >= 0.99 * len(kept)
    assert sum(map(len, clean.values())) < sum(map(len, texts.values()))


def test_rows_that_share_a_key_or_have_none_keep_one_text(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(200))
    for keys in ((7, 7, 7), (None, None, None), (None, 7, 7)):
        docs = spark.createDataFrame([(k, text, "x", n) for n, k in enumerate(keys)] + [(9, None, None, 3), (9, "", "y", 4)], "doc_id long, text string, row string, own_0 long")
        clean = cdc.without_repeats(docs)
        assert clean.columns == docs.columns
        got = sorted((r.own_0, r.doc_id, r.text, r.row) for r in clean.collect())
        assert [x[1] for x in got] == [*keys, 9, 9] and Counter(x[2] for x in got[:3]) == {text: 1, "": 2}
        assert got[3][2] is None and got[4][2] == ""
        report = cdc.passage_report(docs).collect()
        assert len(report) == 5 and sum(r.removed_chars for r in report) == 2 * len(text)


def test_a_shift_moves_only_the_cuts_beside_it(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:200] + ["inserted"] + words[200:]))], "doc_id long, text string")
    got = {r.doc_id: r for r in cdc.passage_report(docs).collect()}
    assert [got[k].n_spans for k in (1, 2)] == [2, 2] and got[1].removed_chars == 0
    assert got[2].spans == f"0:{200 * 7},{200 * 7 + 8}:{401 * 7 + 1}"  # the blanks beside the word are shared too
    assert got[2].removed == got[2].spans
