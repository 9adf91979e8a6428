"""Alignment of two tokenizers' tokens, and how often their ids are linked over a corpus.

A text's tokens by A (byte-level BPE, the text with a space before it) and by B (pieces, which adds the space)
tile the same bytes.  Tokens that share a byte overlap; the connected components of that bipartite graph are
the minimal groups, which both tokenizers cut out alike.  Tokens of a group are linked, each A with each B.

1. Texts are taken in blocks of about ``block_chars`` characters.  Words are encoded once as long as the
   worker's bounded table holds them; a block's groups are cut at the bytes at which
   tokens of both end, which are marked and counted for all texts at once.
2. A group's members expand to links as distinct ids with their numbers, so a group that repeats an id costs
   one entry.  A block keeps each text's distinct id pairs as places in the block's own pair list, and sends
   each distinct pair once with the number of texts that hold it.
3. Pairs are counted over all blocks by a grouped sum with partial sums, the best count of an A id by a
   grouped maximum; both are joined back to the blocks' pairs and answered by place.

Scale: a text is read once and never shuffled; what is shuffled is a block's distinct pairs.  A very frequent
pair costs one row a block.  A block is bounded by block_chars and one text.

Defined cases: null and empty texts have no tokens; texts whose tokens' bytes are not the text's own (as where
a text holds U+2581) have none either; strings of special tokens are plain text; texts of any length are
taken whole; repeated rows each get a row and count each as a text; a null key is kept; columns with other
names do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.llm.bpe import _L, _N, _PLAIN, _pack, _read_bytes, _unpack, byte_letters
from hyphalake.llm.common import Scratch, release

_S = "\t\n\r\x20\xa0"
#: Words of A in texts of plain letters; others take the library's own way.
_WORDS_A = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Parts of B: no piece has a space behind another letter.
_WORDS_B = re.compile(r" +[^ ]*")
#: A worker's table of words: entries, ids, and letters of the longest word that is kept.
ENTRIES, IDS, LONGEST = 300_000, 4_000_000, 64
#: Links expanded at a time.
EXPANDED = 4_000_000


class WordTable(dict):
    """Numbers of words, with the ids of each in one flat array; forgets all words when full."""

    def __init__(self, encode: Callable[[str], list[int]], pieces: list[bytes]):
        super().__init__()
        self.encode, self.pieces = encode, pieces
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.ids, self.begin, self.size, self.whole = array("i"), array("q"), array("q"), array("b")

    def add(self, ids: list[int], data: bytes) -> int:
        self.begin.append(len(self.ids))
        self.size.append(len(ids))
        self.ids.extend(ids)
        self.whole.append(b"".join([self.pieces[i] for i in ids]) == data)
        return len(self.size) - 1

    def __missing__(self, word: str) -> int:
        k = self.add(self.encode(word), word.encode("utf-8"))
        if len(word) <= LONGEST:
            self[word] = k
        return k

    def is_full(self) -> bool:
        return len(self.size) > ENTRIES or len(self.ids) > IDS

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of each word's ids)."""
        begin, size, ids = (np.frombuffer(x, dtype) for x, dtype in ((self.begin, np.int64), (self.size, np.int64), (self.ids, np.int32))) if len(self.ids) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        n = size[codes]
        at = np.repeat(begin[codes] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return ids[at], n


class PairCodec:
    """Both tokenizers: word tables, and the bytes of every id."""

    def __init__(self, blob_a: bytes, blob_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        a, b = Tokenizer.from_str(blob_a.decode("utf-8")), sentencepiece.SentencePieceProcessor(model_proto=blob_b)
        a.no_truncation()
        a.no_padding()
        a.encode_special_tokens = True
        letters = byte_letters()
        back = {c: k for k, c in enumerate(letters)}
        size = a.get_vocab_size(with_added_tokens=True)
        names = [a.id_to_token(k) or "" for k in range(size)]
        bytes_a = [bytes([back[c] for c in x]) if all(c in back for c in x) else x.encode("utf-8") for x in names]
        bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode("utf-8") for k in range(b.get_piece_size())]
        self.a = WordTable(lambda w: [t.id for t in a.model.tokenize("".join([letters[x] for x in w.encode("utf-8")]))], bytes_a)
        self.b = WordTable(lambda w: b.encode(w[1:]) if len(w) > 1 else [b.piece_to_id("▁")], bytes_b)  # the library puts no space before nothing
        self.all_a, self.all_b = lambda text: a.encode(" " + text, add_special_tokens=False).ids, b.encode
        self.len_a, self.len_b = (np.array([*map(len, x)], np.int64) for x in (bytes_a, bytes_b))
        most = max(size, b.get_piece_size())
        #: Decimal ids, each before "", ",", "|" and ";".
        self.decimals, self.most = [f"{k}{end}" for end in ("", ",", "|", ";") for k in range(most)], most

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Numbers of the text's words in both tables, and whether both give the text's own bytes."""
        spaced = " " + text
        if _PLAIN.fullmatch(text):
            found = [[*map(self.a.__getitem__, _WORDS_A.findall(spaced))], [*map(self.b.__getitem__, _WORDS_B.findall(spaced))]]
        else:
            data = spaced.encode("utf-8")
            found = [[self.a.add(self.all_a(text), data)], [self.b.add(self.all_b(text), data)]]
        a, b = (np.array(x, np.int64) for x in found)
        whole = np.frombuffer(self.a.whole, np.int8)[a].all() and np.frombuffer(self.b.whole, np.int8)[b].all()
        return a, b, bool(whole)


@functools.lru_cache(maxsize=1)
def pair_codec(blob_a: bytes, blob_b: bytes) -> PairCodec:
    """One codec a worker process, whatever the number of its tasks."""
    return PairCodec(blob_a, blob_b)


def groups(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, ascending, of the groups of A's and of B's tokens, by their lengths in bytes over the same text: a token's
    is the number of bytes before its end at which tokens of both end."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    size = int(max(end_a[-1:].max(initial=-1), end_b[-1:].max(initial=-1))) + 1
    both, of_b = np.zeros((2, size), bool)
    both[end_a], of_b[end_b] = True, True
    both &= of_b
    before = np.cumsum(both) - both
    return before[end_a], before[end_b]


def _distinct(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their weights."""
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights[:0]


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def links(ids_a: np.ndarray, ids_b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text and id pair, number of links) of all groups; doc is the text of each group, pairs are A's id times 2**16 plus B's."""
    many = lambda of, ids: _counted(of << 17 | ids)
    (key_a, n_a), (key_b, n_b) = many(of_a, ids_a), many(of_b, ids_b)
    group_a, group_b = key_a >> 17, key_b >> 17
    begin = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=len(doc)))))
    width = np.diff(begin)[group_a]
    upto, parts, at = np.cumsum(width), [], 0
    while at < len(key_a):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + EXPANDED, "right")))
        w = width[at:to]
        a = np.repeat(np.arange(at, to), w)
        b = np.repeat(begin[group_a[at:to]] - np.cumsum(w) + w, w) + np.arange(w.sum())
        key = doc[group_a[a]] << 32 | (key_a[a] & 0x1FFFF) << 16 | (key_b[b] & 0x1FFFF)
        parts.append(_distinct(key, n_a[a] * n_b[b]))
        at = to
    if len(parts) == 1:
        return parts[0]
    return _distinct(np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]), np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values that end before ends."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], ends))])


def aligned_block(codec: PairCodec, codes_a: list[np.ndarray], codes_b: list[np.ndarray]) -> dict[str, np.ndarray | list[str]]:
    """Figures of each text of a block, and its distinct pairs: text, pair and links of each, in order."""
    n = len(codes_a)
    ids, ends, size = [], [], []
    for table, codes in ((codec.a, codes_a), (codec.b, codes_b)):
        flat, width = table.gather(np.concatenate(codes))
        ids.append(flat.astype(np.int64))
        size.append(_sums(width, np.cumsum([*map(len, codes)])))
        ends.append(np.cumsum(size[-1]))
    (ids_a, ids_b), (n_a, n_b) = ids, size
    of_a, of_b = groups(codec.len_a[ids_a], codec.len_b[ids_b])  # texts end at cuts of both, so no group spans two
    doc_a = np.repeat(np.arange(n), n_a)
    total = int(of_a[-1]) + 1 if len(of_a) else 0
    in_a, in_b = np.bincount(of_a, minlength=total), np.bincount(of_b, minlength=total)
    doc = np.zeros(total, np.int64)
    doc[of_a] = doc_a
    n_groups = np.bincount(doc, minlength=n)
    n_links = _sums(in_a * in_b, np.cumsum(n_groups))
    # Tokens in the order of the digest: of each group A's, then B's.
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    at_a, at_b = np.arange(len(ids_a)) + (upto_b - in_b)[of_a], np.arange(len(ids_b)) + upto_a[of_b]
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True)[: len(of_a)], np.append(of_b[1:] != of_b[:-1], True)[: len(of_b)]
    said = np.empty(len(ids_a) + len(ids_b), np.int64)
    said[at_a] = np.where(last_a, 2, 1) * codec.most + ids_a
    said[at_b] = np.where(last_b, 3, 1) * codec.most + ids_b
    stops = np.cumsum(n_a + n_b)
    said[stops[n_a > 0] - 1] -= 3 * codec.most  # nothing behind a text's last group
    digests, start, word = [], 0, codec.decimals.__getitem__
    for stop in stops.tolist():
        digests.append(hashlib.sha256("".join(map(word, said[start:stop].tolist())).encode()).hexdigest() if stop > start else "")
        start = stop
    key, weight = links(ids_a, ids_b, of_a, of_b, doc)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests, "doc": key >> 32, "pair": key & 0xFFFFFFFF, "weight": weight}


_KEPT = "kind int, block long, rows array<struct<key:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string>>, ends binary, places binary, weights binary, place int, pair long, docs long"
_FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def aligned_blocks(docs: DataFrame, blob_a: bytes, blob_b: bytes, key: str, text: str, block_chars: int) -> DataFrame:
    """Rows of two kinds: 0 a block's texts with the places of their pairs, 1 each distinct pair of a block."""

    def block_rows(codec: PairCodec, block: int, keys: list, codes: list) -> Iterator[pa.RecordBatch]:
        found = aligned_block(codec, [c[0] for c in codes], [c[1] for c in codes])
        sorted_by = np.argsort(found["pair"])
        pairs = found["pair"][sorted_by]
        starts = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
        inverse = np.empty(len(pairs), np.int64)
        inverse[sorted_by] = np.cumsum(starts) - 1
        firsts = np.flatnonzero(starts)
        pairs, docs_of = pairs[firsts], np.diff(firsts, append=len(pairs))
        order = np.argsort(-docs_of, kind="stable")  # frequent pairs get low places, so places pack well
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        at = place[inverse]
        by = np.argsort(found["doc"] << 32 | at)
        at, weight, doc = at[by], found["weight"][by], found["doc"][by]
        step = np.diff(at, prepend=0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        step[first] = at[first]
        n = len(keys)
        rows = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), *[pa.array(found[c]) for c in _FIGURES]], ["key", *_FIGURES])
        held = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows)
        one = lambda x: pa.array([x], pa.binary())
        none = lambda m, kind: pa.nulls(m, kind)
        names = ["kind", "block", "rows", "ends", "places", "weights", "place", "pair", "docs"]
        ends = np.bincount(doc, minlength=n).astype(np.uint32)
        # A text's links of one pair may exceed 32 bits only beyond four thousand million, where they go in two halves.
        weights = np.concatenate((weight & 0xFFFFFFFF, weight >> 32)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([block], pa.int64()), held, one(_pack(ends)), one(_pack(step.astype(np.uint32))), one(_pack(weights)), none(1, pa.int32()), none(1, pa.int64()), none(1, pa.int64())], names)
        m = len(pairs)
        for k in range(0, m, 65536):
            own = order[k : k + 65536]
            c = len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(c, np.int32)), pa.array(np.full(c, block)), none(c, held.type), none(c, pa.binary()), none(c, pa.binary()), none(c, pa.binary()), pa.array(np.arange(k, k + c, dtype=np.int32)), pa.array(pairs[own]), pa.array(docs_of[own].astype(np.int64))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task = pair_codec(blob_a, blob_b), TaskContext.get().partitionId()
        n, chars, keys, codes = 0, 0, [], []
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1)):
                x = x.as_py() or ""
                a_codes, b_codes, whole = codec.words(x) if x else (*nothing, False)
                keys.append(k)
                codes.append((a_codes, b_codes) if whole else nothing)
                chars += len(x)
                if chars >= block_chars or codec.a.is_full() or codec.b.is_full():
                    yield from block_rows(codec, task << 32 | n, keys, codes)
                    n, chars, keys, codes = n + 1, 0, [], []
                    for table in (codec.a, codec.b):
                        if table.is_full():
                            table.empty()
        if keys:
            yield from block_rows(codec, task << 32 | n, keys, codes)
        release()

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, _KEPT)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): the number of texts that hold a pair, and whether it is the highest of its A id."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 16))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(best, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _answered(block: pa.Table, found: pa.Table) -> pa.Table:
    rows = block.column("rows").combine_chunks().flatten()
    place = found.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    count[place], best[place] = found.column("count").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
    sizes = _unpack(block.column("ends")[0].as_py()).astype(np.int64)
    step, halves = _unpack(block.column("places")[0].as_py()).astype(np.int64), _unpack(block.column("weights")[0].as_py()).astype(np.int64)
    weight = halves[: len(step)] + (halves[len(step) :] << 32)
    sums, ends = np.concatenate(([0], np.cumsum(step))), np.cumsum(sizes)
    at = sums[1:] - np.repeat(sums[ends - sizes], sizes)
    out = [_sums(weight * best[at], ends), _sums(weight * count[at], ends)]
    release()
    return pa.Table.from_arrays([rows.field("key"), *[rows.field(c) for c in _FIGURES], pa.array(out[0]), pa.array(out[1])], ["key", *_FIGURES, "n_best", "count_sum"])


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, key: str = "doc_id", text: str = "text", block_chars: int = 2_500_000) -> tuple[DataFrame, DataFrame]:
    """(one row a row of docs: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; counts of pairs (a, b, count, best))."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    blobs = [_read_bytes(spark, p) for p in (byte_vocabulary, piece_model)]
    kept = scratch.keep(aligned_blocks(docs, *blobs, key, text, block_chars), "blocks", ["kind"])
    pairs = kept.where("kind = 1").select("block", "place", "pair", "docs")
    counts = scratch.keep(pair_counts(pairs), "counts")
    answers = pairs.select("block", "place", "pair").join(counts, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    blocks = kept.where("kind = 0").select("block", "rows", "ends", "places", "weights")
    schema = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    rows = blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_answered, schema)
    named = counts.select(F.shiftright("pair", 16).alias("a"), F.col("pair").bitwiseAND(0xFFFF).alias("b"), "count", "best")
    return rows.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), named
