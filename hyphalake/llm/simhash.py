"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are 64-bit majorities over the XXH64 of word shingles.  Equal fingerprints are one node.
Fingerprints within ``max_bits`` differing bits are linked through the index:

* The top of the hierarchy is a masked bit pattern that a group shares.  Of max_bits + 1 = 4 blocks of
  the bits, two linked fingerprints share one, so each fingerprint goes to 4 groups, keyed by block and
  pattern, and a shuffle by that key builds all groups at once.  A group beyond ``group_rows`` is
  divided again by the same rule over the bits not masked yet, which loses no link either.
* In a group, fingerprints are sorted by Gray rank, so that neighbours share most bits.  Runs of them
  form leaves, runs of leaves form inner nodes; a node holds the mask and the pattern of the bits that
  all below it share, and a child only the bits that its parent lacks.  A search adds up the differing
  bits from the top and leaves a whole node out when they exceed max_bits, or when all below it are
  already in the query's component.

A group sends one edge a linked fingerprint (a star), never all pairs; components of the stars are
found by the shared large-star/small-star rounds.  Nothing here is collected or broadcast.

near_groups() serves similarity limits that 64 bits and few differing bits cannot tell, such as 0.8 of
five-word shingles: no number of bits tells them without losing links beside the limit, so candidates are met
by the bands of minhash and every link is verified on full shingle sets.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; fewer words
than a shingle takes give the whole sequence; an empty table gives an empty table; rows that repeat a
key each get a row; a null key is never the smallest key of a component that has others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.llm import minhash
from hyphalake.llm.common import Scratch, connected_components, in_fixed_order, release

LEAF, FANOUT, QUERIES = 32, 8, 256
_U = np.uint64


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text; A-Z lower-cased, shingles with repeats, seed 42."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.append(gaps, len(joined))[min(words, len(tokens)) - 1 :]
    n, digest, counts = len(ends), xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[k : k + (1 << 15)].tolist(), ends[k : k + (1 << 15)].tolist())], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(b.column(1)[k].as_py(), words) for k in range(len(b))), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> _U(s))
    return x


def _gray_order(codes: np.ndarray, *first: np.ndarray) -> np.ndarray:
    """Order by the given keys and then by the Gray ranks of the codes' words."""
    return np.lexsort([gray_rank(codes[:, w]) for w in range(codes.shape[1] - 1, -1, -1)] + [*first[::-1]])


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (smallest member) after linking i with j."""
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def link_group(codes: np.ndarray, max_bits: int) -> np.ndarray:
    """For each code (row of words), all in Gray order, the index of its component's first member."""
    n = len(codes)
    root = np.arange(n)
    # Nodes of each level, leaves first: first member, bits shared by all (mask) and their values.
    step, levels = LEAF, []
    low = high = codes
    first = np.arange(n)
    while True:
        cut = np.arange(0, len(low), step)
        low, high, first = np.bitwise_and.reduceat(low, cut, axis=0), np.bitwise_or.reduceat(high, cut, axis=0), first[cut]
        levels.append((first, ~(low ^ high), low))
        if len(low) <= FANOUT:
            break
        step = FANOUT
    ends = [np.append(f[1:], n) - 1 for f, _, _ in levels]
    for k in range(0, n, QUERIES):
        q = codes[k : k + QUERIES]
        spans = [(np.minimum.reduceat(root, f), np.maximum.reduceat(root, f)) for f, _, _ in levels]

        def alive(level: int, qi: np.ndarray, node: np.ndarray, acc: np.ndarray) -> tuple:
            """The pairs of query and node that may still hold a new link."""
            same = (spans[level][0][node] == spans[level][1][node]) & (spans[level][0][node] == root[k + qi])
            ok = (acc <= max_bits) & (ends[level][node] > k + qi) & ~same
            return qi[ok], node[ok], acc[ok]

        top = len(levels) - 1
        _, mask, pattern = levels[top]
        qi, node = (x.ravel() for x in np.meshgrid(np.arange(len(q)), np.arange(len(mask)), indexing="ij"))
        qi, node, acc = alive(top, qi, node, _bits((q[qi] ^ pattern[node]) & mask[node]))
        for level in range(top - 1, -1, -1):
            child = node[:, None] * FANOUT + np.arange(FANOUT)
            inside = child < len(levels[level][0])
            up = np.broadcast_to(node[:, None], child.shape)[inside]
            qi, acc, node = np.broadcast_to(qi[:, None], child.shape)[inside], np.broadcast_to(acc[:, None], child.shape)[inside], child[inside]
            _, mask, pattern = levels[level]
            acc = acc + _bits((q[qi] ^ pattern[node]) & mask[node] & ~levels[level + 1][1][up])
            qi, node, acc = alive(level, qi, node, acc)
        for a in range(0, len(node), 1 << 12):
            member = node[a : a + (1 << 12), None] * LEAF + np.arange(LEAF)
            inside = member < n
            own = np.broadcast_to(qi[a : a + (1 << 12), None], member.shape)[inside]
            got = np.broadcast_to(acc[a : a + (1 << 12), None], member.shape)[inside]
            leaf = np.broadcast_to(node[a : a + (1 << 12), None], member.shape)[inside]
            member = member[inside]
            near = member > k + own
            near &= root[member] != root[k + own]
            own, member, got, leaf = own[near], member[near], got[near], leaf[near]
            bits = got + _bits((q[own] ^ codes[member]) & ~levels[0][1][leaf])
            near = bits <= max_bits
            root = _merge(root, k + own[near], member[near])
    return root


def _small_groups(key: np.ndarray, codes: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots for many groups of one leaf each, side by side, in order of key and Gray rank."""
    root, n = np.arange(len(codes)), len(codes)
    for d in range(1, LEAF):
        i = np.flatnonzero(key[: n - d] == key[d:])
        if not len(i):
            break
        i = i[_bits(codes[i] ^ codes[i + d]) <= max_bits]
        root = _merge(root, i, i + d)
    return root


def _stars(batches: Iterator[pa.RecordBatch], max_bits: int, width: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from rows (key, id, words...) sorted by key; carries the last, perhaps unfinished group over."""

    def edges(key: np.ndarray, ids: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        size = np.diff(np.append(cut, len(key)))
        at = np.flatnonzero(np.repeat((size > 1) & (size <= LEAF), size))
        groups = [(at[_gray_order(codes[at], key[at])], True)] + [(a + _gray_order(codes[a : a + n]), False) for a, n in zip(cut[size > LEAF].tolist(), size[size > LEAF].tolist())]
        for at, small in groups:
            root = _small_groups(key[at], codes[at], max_bits) if small else link_group(codes[at], max_bits)
            far = root != np.arange(len(root))
            if far.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[at][far]), pa.array(ids[at][root[far]])], ["a", "b"])

    key, ids, codes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.uint64)
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
        key, ids = np.concatenate((key, cols[0])), np.concatenate((ids, cols[1]))
        codes = np.concatenate((codes, np.column_stack(cols[2:]).view(np.uint64)))
        done = np.flatnonzero(key != key[-1])[-1] + 1 if len(key) and key[0] != key[-1] else 0
        if done:
            yield from edges(key[:done], ids[:done], codes[:done])
            key, ids, codes = key[done:], ids[done:], codes[done:]
    yield from edges(key, ids, codes)
    release()


def _search(groups: DataFrame, max_bits: int, width: int) -> DataFrame:
    """Edges (a, b) of groups (key, id, words...), dealt by key."""
    return groups.repartition("key").sortWithinPartitions("key").mapInArrow(lambda it: _stars(it, max_bits, width), "a long, b long")


def _blocks(rest: str, bits: int, blocks: int) -> list[tuple[str, str]]:
    """SQL for (pattern, remaining bits) of each block of a value of that many bits."""
    out, at = [], 0
    for k in range(blocks):
        width = bits // blocks + (k < bits % blocks)
        low = bits - at - width
        pattern = f"(shiftrightunsigned({rest}, {low}) & {(1 << width) - 1}L)"
        upper = f"shiftleft(shiftrightunsigned({rest}, {low + width}), {low})" if at else "0L"
        remaining = f"({upper} | ({rest} & {(1 << low) - 1}L))" if low else upper
        out.append((pattern, remaining))
        at += width
    return out


def near_links(fps: DataFrame, scratch: Scratch, max_bits: int = 3, group_rows: int = 16384, max_levels: int = 3) -> DataFrame:
    """Star edges (a, b) among distinct fingerprints (fp) within max_bits differing bits.

    Groups of at most group_rows are searched in one task; larger ones are divided again by a further
    pattern, up to max_levels, at which a group shares 16 + 12 + 9 of its 64 bits.
    """
    blocks = max_bits + 1
    bits, now, edges = 64, fps.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key")), None
    for level in range(max_levels):
        parts = _blocks("rest", bits, blocks)
        now = now.select("fp", F.explode(F.array(*[F.struct(F.xxhash64("key", F.lit(level), F.lit(k), F.expr(p)).alias("key"), F.expr(r).alias("rest")) for k, (p, r) in enumerate(parts)])).alias("g")).select("fp", "g.key", "g.rest")
        bits -= bits // blocks
        last = level == max_levels - 1
        if not last:
            sizes = scratch.keep(now.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows), f"large-{level}")
            more = bool(sizes.head(1))
            here = now.join(sizes.select("key"), "key", "left_anti") if more else now
        else:
            more, here = False, now
        found = _search(here.select("key", F.col("fp").alias("id"), "fp"), max_bits, 1)
        edges = found if edges is None else edges.unionByName(found)
        if not more:
            break
        now = now.join(sizes.select("key"), "key", "left_semi").select("fp", "key", "rest")
    return edges


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 3, group_rows: int = 16384) -> DataFrame:
    """One row a row of docs: doc_id, fingerprint (16 lowercase hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most max_bits differing bits.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.keep(fingerprints(docs, key, text, words), "fingerprints")
    nodes = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    edges = near_links(nodes.select("fp"), scratch, max_bits, group_rows)
    found = connected_components(edges, scratch)
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select(F.col("fp").alias("node_fp"), "component_id")
    joined = rows.join(named, rows.fp == named.node_fp)
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of a text's word shingles; a text of fewer words has one, a blank one none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n, digest = max(1, len(tokens) - words + 1) if tokens else 0, xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(tokens[k : k + words]), 42) for k in range(n)], np.uint64)).view(np.int64)


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, group_rows: int = 8192) -> DataFrame:
    """One row a row of docs: row (by scan order), doc_id, component_id, keep_row; linked are texts whose Jaccard index reaches similarity.

    Every link is verified on full shingle sets, and a pair within the limit meets in none of minhash's bands once in a
    million; no pair stands for others.  Blank texts are alike.  keep_row is the row of the smallest key of a component.
    A cell of a large bucket has about group_rows rows a side, long ones counted by their shingles.
    """
    percent = round(100 * similarity)
    if abs(percent - 100 * similarity) > 1e-9:
        raise ValueError("similarity is taken in whole per cent")
    scratch = Scratch(docs.sparkSession, "near")
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    plain = (plain if in_fixed_order(plain) else scratch.keep(plain, "input")).withColumn("row", F.monotonically_increasing_id())
    signed, named = minhash.components(plain, scratch, words, percent, cell=64 * group_rows)
    some = signed.where("n > 0").select("row", "doc_id", "d1", "d2").join(named.select("d1", "d2", "root"), ["d1", "d2"]).select("row", "doc_id", "root")
    coded = scratch.keep(some.unionByName(signed.where("n = 0").select("row", "doc_id", F.lit(-1).cast("long").alias("root"))), "coded")
    # The smallest key, null last, and of its rows the first.
    lowest = scratch.keep(coded.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("low")).select("root", F.col("low.doc_id").alias("component_id"), F.col("low.row").alias("keep_row")), "lowest")
    return coded.join(lowest, "root").select("row", "doc_id", "component_id", "keep_row")


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, in the columns of docs: of each group of near_groups the one with the smallest key,
    row by row, whatever keys they share."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    own = own if in_fixed_order(docs) else Scratch(docs.sparkSession, "near").keep(own, "input")
    gone = near_groups(own, at[key], at[text], **options).where("row <> keep_row").select("row")
    left = own.withColumn("row", F.monotonically_increasing_id()).join(gone, "row", "left_anti")
    return left.select(*[F.col(f"own_{k}").alias(c) for k, c in enumerate(docs.columns)])
