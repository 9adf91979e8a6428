"""Substring deduplication by content-defined chunks.

A gear rolling hash over the UTF-8 bytes (each byte shifts the hash left by one and adds the byte's
random number) ends a chunk where its high bits are zero, so an insertion shifts bytes but moves only
the cuts beside it.  Chunks are deduplicated by digest: a chunk is repeated when its digest occurs
twice.  A passage is a run of repeated chunks, and as the chunk at either end of a shared text is cut
elsewhere in each document, its ends are found exactly: the text beside the run is compared with the
text beside the same chunk in the first and the last row that hold it, as far as either agrees.
Passages of at least ``min_words`` whole words are reported.  Of equal chunks the one in the first row
(in scan order), and in it the first, stays; the others are removed.

Scale: a chunk is about 56 bytes and is shuffled as its digest and row; digests are aggregated with
map-side partials, and the join that tells chunks their first and last row has plain shuffles on both
sides, so that a very frequent chunk is split by adaptive execution.  Texts with repeated chunks are
shuffled once, beside their marks.  What is compared at the ends is a short text, aggregated by digest: a chunk in a third of all rows still has one first and one last row.

Rows are told apart by scan order; an input in no fixed order is kept in a table first.

Defined cases: null text counts as empty and has no chunks; a text shorter than min_words has no span;
positions are code points, end exclusive; repeated rows and keys repeat each other's chunks and each get
a row (the first stays whole); an empty table gives an empty table.  A repeated passage in which no chunk
is cut alike in both places is not seen, nor what goes on for more than ``reach`` characters beside the
cuts: about one in 100 of the shortest.  Repeats within one text alone end at cuts, and so does a run
that an edit breaks off inside a passage whose first and last row agree there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.llm.common import BLANKS, WORD, Scratch, in_fixed_order, release


def gear_table(seed: int = 11) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed) for b in range(256)], np.uint32)


GEAR = gear_table()


def cuts(data: bytes, bits: int = 5, least: int = 24, most: int = 512) -> np.ndarray:
    """Ends of the chunks of data: at gear hashes whose high bits are zero, chunks of least to most bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = GEAR[np.frombuffer(data, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        if n > s:
            h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    ends, last = [], 0
    # A cut stands after a byte that completes a code point, so chunks are text.
    whole = np.append((np.frombuffer(data, np.uint8)[1:] & 0xC0) != 0x80, True)
    for e in (np.flatnonzero((h >> np.uint32(32 - bits) == 0) & whole) + 1).tolist():
        while e - last > most:
            last = _whole(data, last + most)
            ends.append(last)
        if e - last >= least:
            ends.append(e)
            last = e
    while n - last > most:
        last = _whole(data, last + most)
        ends.append(last)
    if last < n:
        ends.append(n)
    return np.array(ends, np.int64)


def _whole(data: bytes, at: int) -> int:
    """The next place from at on where a code point begins."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def _chars(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Code points before each of the given places."""
    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return ends if lead.all() else np.concatenate(([0], np.cumsum(lead)))[ends]


def chunk_digests(data: bytes, ends: np.ndarray) -> list[int]:
    """The signed 64-bit digest of each chunk."""
    digest = xxhash.xxh3_64_digest
    whole = b"".join([digest(data[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())])
    return np.frombuffer(whole, "<i8").tolist()


def chunk_rows(based: DataFrame, bits: int, least: int, most: int) -> DataFrame:
    """(row, n_chunks, digests): the digests of each text's chunks, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for k in range(len(b)):
                data = b.column(1)[k].as_py().encode("utf-8")
                digests.append(chunk_digests(data, cuts(data, bits, least, most)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([*map(len, digests)], pa.int64()), pa.array(digests, pa.list_(pa.int64()))], ["row", "n_chunks", "digests"])

    return based.select("row", "text").mapInArrow(run, "row long, n_chunks long, digests array<long>")


_RUN = re.compile(WORD)
_BLANK = frozenset(BLANKS)
LEFT, RIGHT = 0, 1
_REGION = "no int, start int, end int, words int, lead int, trail int, size int, left_digest long, right_digest long, left_lo boolean, right_lo boolean, left_text string, right_text string, removed array<struct<start:int,end:int>>"


def _words(s: str) -> int:
    return len(_RUN.findall(s))


def regions(text: str, marks: dict[int, tuple[int, int, int]], row: int, min_words: int, reach: int, bits: int, least: int, most: int) -> tuple[list[tuple], list[tuple]]:
    """(regions, sides) of one text.

    marks: of each repeated chunk, by number, the first and last row that hold it and how often it occurs.  Regions are runs of
    repeated chunks that can reach min_words, as tuples of _REGION; sides are (side, digest, text beside)
    of the chunks of which this row is the first or last.
    """
    data = text.encode("utf-8")
    ends = cuts(data, bits, least, most)
    digests, stop = chunk_digests(data, ends), _chars(data, ends).tolist()
    begin = [0, *stop[:-1]]
    first: dict[int, int] = {}
    for k, d in enumerate(digests):
        first.setdefault(d, k)
    hits = sorted(marks)
    beside = {LEFT: lambda k: text[max(0, begin[k] - reach) : begin[k]], RIGHT: lambda k: text[stop[k] : stop[k] + reach]}
    # Where the neighbour has the same rows, as often, no end lies.
    sides = [(s, digests[k], beside[s](k)) for k in hits for s, other in ((LEFT, k - 1), (RIGHT, k + 1)) if row in marks[k][:2] and first[digests[k]] == k and marks.get(other) != marks[k]]
    found, i = [], 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        a, b = hits[i], hits[j]
        left, right, own = beside[LEFT](a), beside[RIGHT](b), text[begin[a] : stop[b]]
        n = _words(own)
        if n + _words(left) + _words(right) >= min_words:
            stays = [marks[k][0] == row and first[digests[k]] == k for k in hits[i : j + 1]]
            gone: list[list[int]] = []
            for k, keep in zip(hits[i : j + 1], stays):
                if not keep:
                    if gone and gone[-1][1] == begin[k]:
                        gone[-1][1] = stop[k]
                    else:
                        gone.append([begin[k], stop[k]])
            lead = next((x for x, c in enumerate(own) if c in _BLANK), len(own))
            trail = next((x for x, c in enumerate(reversed(own)) if c in _BLANK), len(own))
            found.append((len(found), begin[a], stop[b], n, lead, trail, len(text), digests[a], digests[b], stays[0], stays[-1], left, right, [{"start": x, "end": y} for x, y in gone]))
        i = j + 1
    return found, sides


def region_rows(marked: DataFrame, min_words: int, reach: int, bits: int, least: int, most: int) -> DataFrame:
    """(row, doc_id, regions, sides) of each text with repeated chunks."""
    beside = "side int, digest long, beside string"
    schema = f"row long, doc_id long, regions array<struct<{_typed(_REGION)}>>, sides array<struct<{_typed(beside)}>>"
    names = [[f.split(" ")[0] for f in x.split(", ")] for x in (_REGION, beside)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.struct([(n, _ARROW[f.split(" ", 1)[1]]) for n, f in zip(ns, x.split(", "))])) for ns, x in zip(names, (_REGION, beside))]
        for b in batches:
            out: tuple[list, list] = ([], [])
            for k in range(len(b)):
                row, marks = b.column(0)[k].as_py(), {m["at"]: (m["lo"], m["hi"], m["n"]) for m in b.column(3)[k].as_py()}
                for side, found, ns in zip(out, regions(b.column(2)[k].as_py(), marks, row, min_words, reach, bits, least, most), names):
                    side.append([dict(zip(ns, x)) for x in found])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out[0], kinds[0]), pa.array(out[1], kinds[1])], ["row", "doc_id", "regions", "sides"])
        release()

    return marked.select("row", "doc_id", "text", "marks").mapInArrow(run, schema)


_PARTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<struct<start:int,end:int>>": _PARTS}


def _typed(columns: str) -> str:
    return ", ".join(f.replace(" ", ":", 1) for f in columns.split(", "))


def common_end(a: str, b: str) -> int:
    """Length of the longest common end of two texts."""
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[-1 - k] != b[-1 - k]), n)


def extended(r: dict, lefts: list[str], rights: list[str], min_words: int) -> tuple[int, int, int] | None:
    """(start, end, words) of a region with its ends where the text beside it stops to agree, in whole words.

    lefts and rights are the texts beside the same chunks elsewhere; the longest agreement counts.
    """
    own_left, own_right = r["left_text"], r["right_text"][::-1]
    k, m = max(map(lambda x: common_end(own_left, x), lefts), default=0), max(map(lambda x: common_end(own_right, x[::-1]), rights), default=0)
    left, right = own_left[len(own_left) - k :], r["right_text"][:m]
    start, end = r["start"] - k, r["end"] + m
    words = r["words"] + _words(left) + _words(right)
    words -= bool(left and left[-1] not in _BLANK and r["lead"]) + bool(right and right[0] not in _BLANK and r["trail"])
    # A word that goes on outside is not part of the passage.
    if k < len(own_left) and own_left[-1 - k] not in _BLANK or k == len(own_left) and start > 0:
        cut = next((x for x, c in enumerate(left) if c in _BLANK), None)
        piece = cut if cut is not None else k + r["lead"]
        if piece:
            start, words = start + piece, words - 1
    if m < len(own_right) and r["right_text"][m] not in _BLANK or m == len(own_right) and end < r["size"]:
        cut = next((x for x, c in enumerate(reversed(right)) if c in _BLANK), None)
        piece = cut if cut is not None else m + r["trail"]
        if piece:
            end, words = end - piece, words - 1
    return None if words < min_words else (start, end, words)


def _spans(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Spans from regions with the texts beside their end chunks elsewhere."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int64()), ("removed", _PARTS), ("holders", pa.list_(pa.int64()))])
    for b in batches:
        out = []
        for r in b.to_pylist():
            got = extended(r, [x for x in (r["l_lo"], r["l_hi"]) if x is not None], [x for x in (r["r_lo"], r["r_hi"]) if x is not None], min_words)
            if got is None:
                continue
            start, end, words = got
            gone = [[p["start"], p["end"]] for p in r["removed"]]
            # What was found at an end goes the way of the chunk at that end.
            if gone and not r["left_lo"]:
                gone[0][0] = start
            if gone and not r["right_lo"]:
                gone[-1][1] = end
            gone = [{"start": max(x, start), "end": min(y, end)} for x, y in gone if x < end and y > start]
            out.append({"row": r["row"], "doc_id": r["doc_id"], "start": start, "end": end, "words": words, "removed": gone, "holders": sorted({h for h in (r["l_doc"], r["r_doc"]) if h is not None})})
        if out:
            yield from pa.Table.from_pylist(out, schema).to_batches()


def _based(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """docs with the columns row, doc_id and text of this module beside its own, renamed."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    own = own if in_fixed_order(docs) else scratch.keep(own, "input")
    return own.select("*", F.monotonically_increasing_id().alias("row"), F.col(at[key]).cast("long").alias("doc_id"), F.coalesce(F.col(at[text]).cast("string"), F.lit("")).alias("text"))


def _passages(based: DataFrame, scratch: Scratch, min_words: int = 50, reach: int = 256, bits: int = 5, least: int = 24, most: int = 512) -> tuple[DataFrame, DataFrame]:
    found = scratch.keep(chunk_rows(based, bits, least, most), "chunks")
    chunks = found.select("row", F.posexplode("digests").alias("at", "digest"))
    twice = chunks.groupBy("digest").agg(F.min("row").alias("lo"), F.max("row").alias("hi"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Kept in a table, so that the join has plain shuffles on both sides and a frequent chunk's rows are split.
    twice = scratch.keep(twice, "repeated")
    marks = chunks.join(twice, "digest").groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi", "n")).alias("marks"))
    made = scratch.keep(region_rows(based.select("row", "doc_id", "text").join(marks, "row"), min_words, reach, bits, least, most), "regions")
    asked = made.select("row", "doc_id", F.explode("regions").alias("r")).select("row", "doc_id", "r.*")
    wanted = asked.select(F.explode(F.array(F.struct(F.lit(LEFT).alias("side"), F.col("left_digest").alias("digest")), F.struct(F.lit(RIGHT).alias("side"), F.col("right_digest").alias("digest")))).alias("w")).select("w.*").distinct()
    sides = made.select("row", "doc_id", F.explode("sides").alias("s")).select("row", "doc_id", "s.*").join(wanted, ["side", "digest"], "left_semi")
    ends = scratch.keep(sides.groupBy("side", "digest").agg(F.min_by("beside", "row").alias("at_lo"), F.max_by("beside", "row").alias("at_hi"), F.min_by("doc_id", "row").alias("doc"), F.min("row").alias("lo"), F.max("row").alias("hi")), "ends")
    out = asked
    for side, c in ((LEFT, "l"), (RIGHT, "r")):
        own = ends.where(F.col("side") == side).select(F.col("digest").alias(f"{'left' if c == 'l' else 'right'}_digest"), F.col("at_lo").alias(f"{c}_lo"), F.col("at_hi").alias(f"{c}_hi"), F.col("doc").alias(f"{c}_doc"), F.col("lo").alias(f"{c}_lo_row"), F.col("hi").alias(f"{c}_hi_row"))
        out = out.join(own, own.columns[0], "left")
        # Another row's text is compared; the own one only where all repeats are in this row.
        for e in ("lo", "hi"):
            out = out.withColumn(f"{c}_{e}", F.when((F.col(f"{c}_{e}_row") != F.col("row")), F.col(f"{c}_{e}")))
    spans = out.mapInArrow(lambda it: _spans(it, min_words), "row long, doc_id long, start int, end int, words long, removed array<struct<start:int,end:int>>, holders array<long>")
    return based.select("row", "doc_id").join(found.select("row", "n_chunks"), "row"), spans


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> tuple[DataFrame, DataFrame]:
    """(rows, spans).

    rows, one a row of docs: doc_id, row, n_chunks.  spans: doc_id, row, start, end, words, removed,
    holders - passages of at least min_words words that occur elsewhere too; removed lists the parts of
    the span that stay elsewhere, and holders the keys of the first rows that hold its end chunks.
    """
    scratch = Scratch(docs.sparkSession, "cdc")
    return _passages(_based(docs, key, text, scratch), scratch, **options)


def passage_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row a row of docs: doc_id, n_chunks, n_spans, has_repeat, repeated_chars, removed_chars, spans and removed
    (start:end, comma-joined), holders (keys of the first rows that hold the spans' end chunks; rows that share
    a passage share one)."""
    rows, spans = repeated_passages(docs, key, text, **options)
    show = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    by = spans.withColumn("gone", length).groupBy("row").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("end") - F.col("start")).alias("repeated_chars"), F.sum("gone").alias("removed_chars"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"), F.array_sort(F.flatten(F.collect_list("removed"))).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("holders")))).alias("holders"))
    zero = F.lit(0).cast("long")
    return rows.join(by, "row", "left").select("doc_id", "n_chunks", F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("repeated_chars", zero).alias("repeated_chars"), F.coalesce("removed_chars", zero).alias("removed_chars"), F.coalesce(show(F.col("s")), F.lit("")).alias("spans"), F.coalesce(show(F.col("r")), F.lit("")).alias("removed"), (F.coalesce("n_spans", zero) > 0).alias("has_repeat"), F.coalesce("holders", F.array().cast("array<long>")).alias("holders"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with the parts of repeated passages that stay elsewhere cut from the text, row by row whatever the keys."""
    scratch = Scratch(docs.sparkSession, "cdc")
    based = _based(docs, key, text, scratch)
    _, spans = _passages(based, scratch, **options)
    gone = spans.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("removed"))).alias("_r")).where(F.size("_r") > 0)
    joined = based.join(gone, "row", "left")
    # Parts of two spans may overlap at their ends; each begins no earlier than the one before ends.
    done = F.transform(F.sequence(F.lit(0), F.size("_r")), lambda k: F.when(k == 0, 0).otherwise(F.array_max(F.transform(F.slice("_r", 1, k), lambda x: x["end"]))))
    ends = F.concat(F.transform("_r", lambda x: x["start"]), F.array(F.length("text")))
    left = F.array_join(F.zip_with(done, ends, lambda a, b: F.substring(F.col("text"), a + 1, F.greatest(b - a, F.lit(0)))), "")
    return joined.select(*[(F.when(F.col("_r").isNull(), F.col(f"own_{k}")).otherwise(left) if c == text else F.col(f"own_{k}")).alias(c) for k, c in enumerate(docs.columns)])
