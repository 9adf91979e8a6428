"""Token ids in training order, as fixed-stride binary shards.

Every document's ids are cut into sequences of ``seq_len``, the last padded.  Sequences have a dense
index in scan order, and a keyed Feistel network over the next even number of bits maps it to a global
slot; an image beyond the last slot is mapped again until it falls inside (cycle-walking), so slots are
a permutation of 0..N-1 that any task can compute for any index.  Slots are range-partitioned by shard
and sorted, and each shard is one binary object without any framing: slot s is the record s mod
shard_seqs of shard s div shard_seqs, at byte (s mod shard_seqs) * stride.  A training run maps a shard
into memory and reads on from any slot.

A record is a header (doc_id, place of the sequence in its document, number of ids; big-endian),
seq_len ids (little-endian, ``id_bytes`` each) and one line feed.  Objects are named part-<shard>-...
and are written by Spark's text writer through its committer, which takes the record's bytes as they
are and ends each with the line feed; so they lie in any store that Spark writes to, a lost executor's
shards are written again and no reader sees a part.

Ids are those of an ids column (binary, little-endian unsigned 32-bit as encode_decode() gives them) or,
without one, the UTF-8 bytes of the text, which need no tokenising: END and PAD are the values 255 and
254, which UTF-8 never holds.  For ids of a vocabulary END and PAD follow its last id.

Scale: ids are shuffled once, compressed by record.  The driver holds one count a scan partition and
sends it to each executor once, as Spark's own zipWithIndex does.  The scan runs twice and must give
the same partitions: an input that a shuffle or another source leaves in no fixed order is kept in a
table first, and a task that finds another count fails instead of misplacing rows.  Shards of the
default size are 34 MB; a reading task holds one, so choose more sequences only with its memory in mind.

Defined cases: null text or ids count as empty and are one sequence of END and PAD; repeated rows each
get their own sequences; a null key stays null; an empty table writes no shards.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.llm.common import Scratch, in_fixed_order, listed

END, PAD = 255, 254
#: doc_id, place of the sequence in its document, number of ids (its high bit: the key is null).
HEADER = ">qII"
HEADER_BYTES = struct.calcsize(HEADER)
NO_KEY = 1 << 31


def feistel(index: np.ndarray, n: int, key: bytes, rounds: int = 6) -> np.ndarray:
    """The slots of the given indices: a keyed permutation of range(n)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(key + bytes([r]), digest_size=8).digest(), "little")) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> h, x & mask
        for k in keys:
            z = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & mask)
        return (left << h) | right

    with np.errstate(over="ignore"):
        slot = once(np.asarray(index, np.uint64))
        while len(out := np.flatnonzero(slot >= np.uint64(n))):
            slot[out] = once(slot[out])
    return slot.astype(np.int64)


def record_bytes(seq_len: int, id_bytes: int = 1) -> int:
    """The stride: bytes from one record to the next."""
    return HEADER_BYTES + seq_len * id_bytes + 1


def _plain(docs: DataFrame, key: str, text: str, ids: str | None) -> DataFrame:
    """(doc_id, body): the document's ids, as they are, in bytes."""
    empty = F.lit(b"")
    body = F.coalesce(F.col(text).cast("string").cast("binary"), empty) if ids is None else F.coalesce(F.col(ids), empty)
    return docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("body"))


def sequences(docs: DataFrame, key: str, text: str, ids: str | None, seq_len: int, seed: bytes) -> tuple[DataFrame, int]:
    """((slot, doc_id, seq, body) rows, their number): body holds the sequence's ids without END and PAD, compressed."""
    width = 1 if ids is None else 4
    plain = _plain(docs, key, text, ids)
    n_seqs = F.expr(f"(octet_length(body) div {width} + {seq_len}) div {seq_len}")
    counted = plain.select(F.spark_partition_id().alias("p"), n_seqs.alias("n")).groupBy("p").agg(F.sum("n").alias("n"))
    counts = {r.p: r.n for r in counted.collect()}
    bases, total = {}, 0
    for p in sorted(counts):
        bases[p] = total
        total += counts[p]
    # One number a scan partition, sent to each executor once.
    held = docs.sparkSession.sparkContext.broadcast((bases, counts))
    step = seq_len * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        at = base = held.value[0].get(task, 0)
        due = held.value[1].get(task, 0)
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=False)
        for b in batches:
            keys = b.column(0).to_pylist()
            owner, seq, body = [], [], []
            for k in range(len(b)):
                data = b.column(1)[k].as_py()
                n = (len(data) // width + seq_len) // seq_len
                for first in range(0, n, 4096):
                    some = range(first, min(n, first + 4096))
                    owner += [keys[k]] * len(some)
                    seq += some
                    body += [pack.compress(data[i * step : (i + 1) * step]) for i in some]
                    if len(body) >= 4096 or (k == len(b) - 1 and some.stop == n):
                        slots = feistel(np.arange(at, at + len(body)), total, seed)
                        at += len(body)
                        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(owner, pa.int64()), pa.array(seq, pa.int32()), pa.array(body, pa.binary())], ["slot", "doc_id", "seq", "body"])
                        owner, seq, body = [], [], []
        if at - base != due:
            raise RuntimeError(f"partition {task} has {at - base} sequences now and had {due}; keep the input in a table first")

    return plain.mapInArrow(run, "slot long, doc_id long, seq int, body binary"), total


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", ids: str | None = None, seq_len: int = 1024, shard_seqs: int = 32768, id_bytes: int | None = None, end: int = END, pad: int = PAD, seed: bytes = b"order-0") -> int:
    """Writes the shards of docs in training order and returns the number of sequences.

    ids names a column of little-endian unsigned 32-bit ids, which are stored in id_bytes (1, 2 or 4)
    bytes with the given END and PAD; an id that does not fit fails.
    """
    width, id_bytes = (1, 1) if ids is None else (4, id_bytes or 4)
    if not in_fixed_order(docs):
        docs = Scratch(docs.sparkSession, "token-store").keep(docs, "input")
    rows, total = sequences(docs, key, text, ids, seq_len, seed)
    if not total:
        return 0
    held_as, stored = f"<u{width}", f"<u{id_bytes}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last = None
        for b in batches:
            slots = b.column(0).to_pylist()
            for x, y in zip([last, *slots] if last is not None else slots, slots if last is not None else slots[1:]):
                if y != x + 1 and x // shard_seqs == y // shard_seqs:
                    raise RuntimeError(f"shard {x // shard_seqs} has gaps")
            last = slots[-1] if slots else last
            for k in range(0, len(b), 512):
                out = []
                for owner, seq, body in zip(*(b.column(c).slice(k, 512).to_pylist() for c in (1, 2, 3))):
                    own = np.frombuffer(unpack.decompress(body), held_as)
                    if len(own) and int(own.max()) >> (8 * id_bytes):
                        raise ValueError(f"id {own.max()} does not fit {id_bytes} bytes")
                    n = min(seq_len, len(own) + 1)
                    buf = np.full(seq_len, pad, stored)
                    buf[: len(own)] = own
                    if len(own) < seq_len:
                        buf[len(own)] = end
                    out.append(struct.pack(HEADER, owner or 0, seq, n | (NO_KEY if owner is None else 0)) + buf.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    # A partition is a shard, so the number in its file's name is the shard's.
    n_shards = -(-total // shard_seqs)
    dealt = rows.withColumn("shard", F.expr(f"cast(slot div {shard_seqs} as int)")).repartitionById(n_shards, "shard").sortWithinPartitions("slot").select("slot", "doc_id", "seq", "body")
    done = dealt.mapInArrow(pack, "record binary").select(F.col("record").cast("string").alias("record"))
    done.write.mode("overwrite").option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", 0).text(path)
    return total


def _shards(spark: SparkSession, path: str, shard_seqs: int, start: int, stop: int | None) -> DataFrame:
    """The objects that hold slots start..stop, and their shards; others are not opened."""
    first, last = start // shard_seqs, None if stop is None else max(stop - 1, 0) // shard_seqs
    files: str | list[str] = path
    if first or last is not None:
        names = {int(m[1]): n for n in listed(spark, path) if (m := re.search(r"/part-(\d+)-[^/]*$", n))}
        files = [n for k, n in sorted(names.items()) if k >= first and (last is None or k <= last)]
        if not files:
            return spark.read.format("binaryFile").load(path).where("false").withColumn("shard", F.lit(0).cast("long"))
    shard = F.regexp_extract("path", r"/part-(\d+)-[^/]*$", 1).cast("long")
    return spark.read.format("binaryFile").load(files).withColumn("shard", shard)


def shard_objects(spark: SparkSession, path: str, shard_seqs: int = 32768, start: int = 0, stop: int | None = None) -> DataFrame:
    """(shard, path, length) of the objects that hold slots start..stop; their content is not read."""
    return _shards(spark, path, shard_seqs, start, stop).select("shard", "path", "length")


def read_record(stream, k: int, seq_len: int = 1024, id_bytes: int = 1) -> tuple[int | None, int, np.ndarray]:
    """(doc_id, seq, ids with END, without PAD) of record k of one shard, by a seek in an open binary stream."""
    stream.seek(k * record_bytes(seq_len, id_bytes))
    data = stream.read(record_bytes(seq_len, id_bytes))
    owner, seq, n = struct.unpack_from(HEADER, data)
    found = np.frombuffer(data, f"<u{id_bytes}", seq_len, HEADER_BYTES)
    return None if n & NO_KEY else owner, seq, found[: n & ~NO_KEY]


def read_slots(spark: SparkSession, path: str, seq_len: int = 1024, shard_seqs: int = 32768, id_bytes: int = 1, start: int = 0, stop: int | None = None) -> DataFrame:
    """(slot, shard, offset, doc_id, seq, n_tokens, ids) of slots start..stop; only their shards are read.

    A task holds one shard at a time, so shard_seqs bounds its memory.
    """
    stride = record_bytes(seq_len, id_bytes)
    one = _shards(spark, path, shard_seqs, start, stop).select("shard", "content", F.explode(F.sequence(F.lit(0), F.expr(f"cast(length div {stride} as int) - 1"))).alias("k"))
    one = one.select("shard", "k", F.expr(f"substring(content, k * {stride} + 1, {stride})").alias("record"))

    def number(at: int) -> Column:
        """Four bytes of the header, unsigned."""
        return F.conv(F.hex(F.expr(f"substring(record, {at + 1}, 4)")), 16, 10).cast("long")

    flagged = number(12)
    owner = F.when(flagged < NO_KEY, F.shiftleft(number(0), 32).bitwiseOR(number(4)))
    ids = F.expr(f"substring(record, {HEADER_BYTES + 1}, {seq_len * id_bytes})")
    out = one.select((F.col("shard") * shard_seqs + F.col("k")).alias("slot"), "shard", (F.col("k").cast("long") * stride).alias("offset"), owner.alias("doc_id"), number(8).cast("int").alias("seq"), flagged.bitwiseAND(F.lit(NO_KEY - 1)).cast("int").alias("n_tokens"), ids.alias("ids"))
    return out.where(F.col("slot") >= start) if stop is None else out.where((F.col("slot") >= start) & (F.col("slot") < stop))


def training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Writes docs to shards in the shared folder and reads all slots back."""
    spark = docs.sparkSession
    path = f"{Scratch(spark, 'token-store').root}/shards"
    if write_shards(docs, path, key, text, **options) == 0:
        return spark.createDataFrame([], "slot long, shard long, offset long, doc_id long, seq int, n_tokens int, ids binary")
    sizes = {k: v for k, v in options.items() if k in ("seq_len", "shard_seqs")}
    width = 1 if options.get("ids") is None else options.get("id_bytes") or 4
    return read_slots(spark, path, id_bytes=width, **sizes)
