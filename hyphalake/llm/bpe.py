"""BPE encoding and decoding by a distinct-word table.

1. Texts are split to words, in blocks of about ``block_chars`` characters.  A block keeps its texts as
   positions in its own list of distinct words, which goes by frequency so that positions pack well, and
   sends each distinct word, once, to the part of the word table that the word's hash names (packed, one
   row a block and part).
2. Each part of the table gathers its words over all blocks, encodes every distinct one once with the
   tokenizer's model, and answers each block in the order of the words it sent.
3. A block joins the answers with its positions: ids of a word go to all places of the word.  Decoding
   maps the ids through the id-to-piece table, whose size is the vocabulary's.

Scale: a text is read once and never shuffled; what is shuffled is a block's distinct words, their ids
and the packed positions.  A very frequent word costs one entry a block, so no word makes a hot key,
and a block is bounded by block_chars (and one text).  Parts follow spark.sql.shuffle.partitions.

Defined cases: null text counts as empty and has no ids; texts of any length are encoded whole; the
special tokens' strings are found before the normaliser runs, as the library does; repeated rows each
get a row; carried columns may have any names; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hyphalake.llm.common import Scratch, release, shuffle_partitions

#: Characters for which the normaliser only lower-cases, one by one: printable ASCII, Latin-1 and
#: Latin Extended-A (without the dotted capital I), general punctuation.  Others take the library's path.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-įı-ſ‐-‧‰-⁞]*")
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r\x20\xa0{_L}{_N}]+")
#: Compression of what is kept and shuffled.
LEVEL = 9
_PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it prints, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordCodec:
    """The words of a text, and ids and pieces of a word, for one tokenizers file."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        self.tok = Tokenizer.from_str(blob.decode("utf-8"))
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.letters = byte_letters()
        self.back = {c: b for b, c in enumerate(self.letters)}
        splits = [p["pattern"].get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.plain = splits == [_PLAIN_PATTERN] and kinds == ["NFC", "Replace", "Lowercase"]
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.pieces = [self.tok.id_to_token(i) or "" for i in range(size)]

    def words(self, text: str) -> list[str]:
        if self.cut is not None and "<|" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                return [w for p in parts if p for w in ([p] if p in self.added else self._split(p))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if self.plain and _PLAIN.fullmatch(text):
            return _WORDS.findall(text.lower())
        norm = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        back = self.back
        return [bytes([back[c] for c in w]).decode("utf-8") for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm)]

    def encode_word(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        return [t.id for t in self.tok.model.tokenize("".join([self.letters[b] for b in word.encode("utf-8")]))]


@functools.lru_cache(maxsize=1)
def word_codec(blob: bytes) -> WordCodec:
    """One codec a worker process, whatever the number of its tasks."""
    return WordCodec(blob)


def _pack(values: np.ndarray) -> bytes:
    """Planes of the bytes of unsigned 32-bit values, compressed."""
    return zstandard.ZstdCompressor(level=LEVEL).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).reshape(-1).view("<u4")


def _read_bytes(spark, path: str) -> bytes:
    """The tokenizer's file, by Spark's reader; a file of fixed size that tasks get with their code."""
    local = path if "://" in path else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(local).select("content").first()[0])


def _pack_positions(codes: np.ndarray) -> tuple[bytes, bytes]:
    """A byte for each of the 255 first places and an escape for others, and the others."""
    first = np.minimum(codes, 255).astype(np.uint8)
    return zstandard.ZstdCompressor(level=LEVEL).compress(first.tobytes()), _pack(codes[codes >= 255] - 255)


def _unpack_positions(body: bytes, tail: bytes) -> np.ndarray:
    codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).astype(np.uint32)
    codes[codes == 255] = _unpack(tail) + 255
    return codes


def split_blocks(docs: DataFrame, blob: bytes, text: str, carry: Sequence[str], block_chars: int, parts: int) -> DataFrame:
    """Rows of two kinds: 0 a block's rows, text lengths and positions, 1 a block's words for one part.

    A packet of words also names their places in the block's list, so answers can be joined by position.
    """
    plain = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("rows", T.ArrayType(plain.schema["row"].dataType))]).add("block", "string").add("part", "integer").add("lengths", "binary").add("body", "binary").add("tail", "binary").add("kind", "integer")
    names = schema.names
    digest = xxhash.xxh3_64_intdigest

    def block_rows(block: str, rows: list[pa.Array], codes: list[np.ndarray], seen: dict[str, int]) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(codes)
        words, counts = list(seen), np.bincount(flat, minlength=len(seen)).tolist()
        part = [digest(w) % parts for w in words]
        order = sorted(range(len(words)), key=lambda k: (-counts[k], part[k], words[k]))
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        body, tail = _pack_positions(place[flat])
        every = pa.concat_arrays(rows)
        held = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every)
        one = lambda x, kind: pa.array([x], kind)
        yield pa.RecordBatch.from_arrays([held, one(block, pa.string()), one(0, pa.int32()), one(_pack(np.array([*map(len, codes)], np.uint32)), pa.binary()), one(body, pa.binary()), one(tail, pa.binary()), one(0, pa.int32())], names)
        to: list[list[int]] = [[] for _ in range(parts)]
        for k in order:
            to[part[k]].append(k)
        used = [p for p in range(parts) if to[p]]
        n = len(used)
        packets = [zstandard.ZstdCompressor(level=LEVEL).compress("\n".join([words[k] for k in to[p]]).encode("utf-8")) for p in used]
        places = [_pack(np.diff(place[to[p]], prepend=np.uint32(0))) for p in used]
        yield pa.RecordBatch.from_arrays([pa.nulls(n, held.type), pa.array([block] * n, pa.string()), pa.array(used, pa.int32()), pa.nulls(n, pa.binary()), pa.array(packets, pa.binary()), pa.array(places, pa.binary()), pa.array([1] * n, pa.int32())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task, n, chars = word_codec(blob), TaskContext.get().partitionId(), 0, 0
        rows: list[pa.Array] = []
        codes: list[np.ndarray] = []
        seen: defaultdict[str, int] = defaultdict()
        seen.default_factory = seen.__len__
        for b in batches:
            start = 0
            for k in range(len(b)):
                x = b.column(1)[k].as_py() or ""
                codes.append(np.array([*map(seen.__getitem__, codec.words(x))], np.uint32))
                chars += len(x)
                if chars >= block_chars:
                    rows.append(b.column(0).slice(start, k + 1 - start))
                    yield from block_rows(f"{task}-{n}", rows, codes, seen)
                    seen.clear()
                    rows, codes, start, n, chars = [], [], k + 1, n + 1, 0
            if start < len(b):
                rows.append(b.column(0).slice(start))
        if rows:
            yield from block_rows(f"{task}-{n}", rows, codes, seen)
        release()

    return plain.mapInArrow(run, schema)


def encode_parts(packets: DataFrame, blob: bytes, parts: int) -> DataFrame:
    """(block, places, lengths, ids) of each packet: a part encodes each of its distinct words once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(blob)
        table: dict[str, bytes] = {}
        part = None
        for b in batches:
            lengths, flat = [], []
            for p, body in zip(b.column(1).to_pylist(), b.column(3).to_pylist()):
                if p != part:
                    part, table = p, {}
                got = []
                for w in zstandard.ZstdDecompressor().decompress(body).decode("utf-8").split("\n"):
                    ids = table.get(w)
                    if ids is None:
                        ids = table[w] = np.array(codec.encode_word(w), "<u4").tobytes()
                    got.append(ids)
                lengths.append(_pack(np.array([len(x) // 4 for x in got], np.uint32)))
                flat.append(_pack(np.frombuffer(b"".join(got), "<u4")))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(lengths, pa.binary()), pa.array(flat, pa.binary())], ["block", "places", "lengths", "ids"])
        table.clear()
        release()

    dealt = packets.select("block", "part", F.col("tail").alias("places"), "body").repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "block string, places binary, lengths binary, ids binary")


def join_ids(blocks: DataFrame, answers: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """(row, n_tokens, ids, decoded): a block's answers joined with its texts by position.

    pieces is the id-to-piece table; its size is the vocabulary's.
    """
    names = ["row", "n_tokens", "ids", "decoded"]

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        places, lengths, flat = ([_unpack(x.as_py()) for x in found.column(c)] for c in ("places", "lengths", "ids"))
        none = [np.zeros(0, np.uint32)]
        at = np.concatenate([np.cumsum(p, dtype=np.int64) for p in places] or none).astype(np.int64)
        sizes, every = np.concatenate(lengths or none).astype(np.int64), np.concatenate(flat or none)
        # Where a word's ids begin among all, and how many there are, by the word's place.
        begin, count = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        begin[at], count[at] = np.cumsum(sizes) - sizes, sizes
        ids, decoded, start = [], [], 0
        held = block.column("rows").combine_chunks()
        codes = _unpack_positions(block.column("body")[0].as_py(), block.column("tail")[0].as_py())
        for n in _unpack(block.column("lengths")[0].as_py()).tolist():
            own = codes[start : start + n]
            start += n
            size = count[own]
            own = every[np.repeat(begin[own] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            ids.append(own.astype("<u4").tobytes())
            decoded.append(" ".join([pieces[i] for i in own.tolist()]))
        release()
        return pa.Table.from_arrays([held.flatten(), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names)

    schema = T.StructType([T.StructField("row", blocks.schema["rows"].dataType.elementType)]).add("n_tokens", "long").add("ids", "binary").add("decoded", "string")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", carry: Sequence[str] = ("doc_id",), block_chars: int = 8_000_000) -> DataFrame:
    """The carried columns of each row, n_tokens, ids (little-endian unsigned 32-bit) and decoded text.

    ids are those of the tokenizers library with add_special_tokens=False; decoded is its
    decode(ids, skip_special_tokens=False) for files without a decoder of their own, which joins
    pieces by a space.  vocabulary is the path of a tokenizers file.
    """
    spark = docs.sparkSession
    blob = _read_bytes(spark, vocabulary)
    scratch, parts = Scratch(spark, "bpe"), shuffle_partitions(spark)
    split = scratch.keep(split_blocks(docs, blob, text, carry, block_chars, parts), "blocks", ["kind"])
    answers = encode_parts(split.where("kind = 1"), blob, parts)
    done = join_ids(split.where("kind = 0").select("block", "rows", "lengths", "body", "tail"), answers, word_codec(blob).pieces)
    return done.select(*[F.col("row")[c].alias(c) for c in carry], "n_tokens", "ids", "decoded")
