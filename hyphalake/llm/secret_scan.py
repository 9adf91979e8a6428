"""Secret scan: fixed patterns, and sliding-window Shannon entropy by character class.

Patterns give the base spans.  The entropy method takes candidate strings, runs of one character class
of at least ``window`` characters, and slides a window over them: counts by character change by one in
and one out, and with them sum(c * log2 c), so a step costs two table reads.  Windows whose entropy
reaches the class's limit are merged to spans, unless the allow-list matches the candidate; its
patterns of a word anywhere (".*word.*") leave out only the windows that hold the word.

Scale: one narrow pass, nothing shuffled; a text is scanned only if a cheap test says it may hold a
match.  Memory is one Arrow batch.

Defined cases: null text counts as empty; positions are code points, end exclusive; texts of any
length are scanned whole; repeated rows each get a row; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_lower")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of [0-9a-f]+ are maximal, so the short ones need not be matched first.
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("passw", "secret", "token", "apikey", "api_key")

#: Character classes of candidates: name, run, window limit in bits, and what a run must also hold.
CLASSES = (
    ("entropy_hex", re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])"), 3.0, re.compile(r"[0-9]")),
    ("entropy_base64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 3.8, re.compile(r"(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])")),
    ("entropy_lower", re.compile(r"(?<![A-Za-z0-9])[a-z0-9]{20,}(?![A-Za-z0-9])"), 3.8, re.compile(r"(?=.*[0-9])(?=.*[g-z])")),
)
#: Candidates that are no secrets: UUIDs, dated slugs and paths of words, integrity hashes' names, samples.
ALLOW = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i).*(example|sample|placeholder|changeme|dummy|redacted).*",
    r"(?i).*(0123456789|abcdefghijklm).*",
    r"[A-Za-z]*([-_/][A-Za-z]+|[-_/][0-9]{1,4})+/?",
)


def entropy_windows(s: str, limit: float, window: int, words: re.Pattern | None = None) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of s with at least limit bits a character that words does not match."""
    plog = [0.0] + [c * log2(c) for c in range(1, window + 2)]  # a character is counted in before one is counted out
    counts: dict[str, int] = {}
    total, out, most = 0.0, [], log2(window)
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += plog[c + 1] - plog[c]
        counts[ch] = c + 1
        if i >= window:
            gone = s[i - window]
            c = counts[gone]
            total += plog[c - 1] - plog[c]
            counts[gone] = c - 1
        if i >= window - 1 and most - total / window >= limit - 1e-9:
            a = i - window + 1
            if words and words.fullmatch(s, a, i + 1):
                continue
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def scan(text: str | None, allow: re.Pattern | None = None, window: int = 20, classes: Sequence = CLASSES, words: re.Pattern | None = None) -> list[tuple[str, int, int]]:
    """All spans of one text as (kind, start, end), by start and then kind as listed."""
    text = text or ""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if max(map(len, text.split()), default=0) >= min(window, 24):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        for kind, run, limit, needs in classes:
            for m in run.finditer(text):
                if len(m[0]) >= window and needs.search(m[0]) and not (allow and allow.fullmatch(m[0])):
                    found += [(kind, m.start() + a, m.start() + b) for a, b in entropy_windows(m[0], limit, window, words if words and words.fullmatch(m[0]) else None)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", allow: Sequence[str] = ALLOW, window: int = 20) -> DataFrame:
    """One row a row of docs: doc_id, spans array<struct<kind, start, end>> in order of start and kind.

    Patterns in allow match whole; each keeps its own flags, which may stand in front as in "(?i)word".
    """
    plain = [scoped(p) for p in allow]
    # Patterns of a word anywhere leave out the windows that hold it; others the whole candidate.
    allowed, held = ("|".join(p for p, anywhere in plain if anywhere == some) for some in (False, True))
    kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(allowed) if allowed else None
        words = re.compile(held) if held else None
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(x, pattern, window, words=words)] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(kinds))], ["doc_id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def scoped(pattern: str) -> tuple[str, bool]:
    """(the pattern with its leading flags for itself alone, whether it matches a word anywhere)."""
    flags = re.match(r"\(\?([aimsux]+)\)", pattern)
    body = pattern[flags.end() :] if flags else pattern
    return f"(?{flags[1]}:{body})" if flags else f"(?:{body})", body.startswith(".*")


def span_report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) from find_secrets' rows."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
