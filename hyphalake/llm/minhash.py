"""MinHash near-duplicates by min-max hashing, exact on full sets.

A document's set are the hashes of its distinct word shingles.  Every permutation gives two values, the least
and the greatest hash under it; both agree between two sets with probability their Jaccard index, so half the
permutations give a signature of the same variance.  Bands of ``rows`` values, each of other permutations,
are keys; the number of bands follows from ``miss``, the share of pairs at the limit that may meet in no band
(one in a million).

1. Equal sets are one node.  Nodes that share a band's key form a bucket; a bucket sends one pair a member,
   with its first node (a star), verified on full sets.
2. Buckets whose other members lie in more than one component of those links go on.  Equal buckets count once.
   A bucket is searched in cells of bounded size: of members of its largest component with others, and of the
   others among themselves, never within one component.  In a cell, an exact prefix filter (a pair within the
   limit shares one of each one's rarest fifth of shingles, counted in the cell) leaves the pairs that are
   verified; it is here that members of a family who differ from each other by more than the limit drop out
   without being paired.
3. Components of all links are found by large-star/small-star rounds.

Scale: texts are read twice, the second time only rows that met another; shuffled are the bands of a node (8
bytes of key each), pairs in proportion to nodes, and sets of nodes that met.  Nothing is collected or
broadcast.  Over a corpus of 10^9 documents and more take rows=8, as chance meetings grow with the square of
the number of documents and fall with the power of rows.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; fewer words than a
shingle takes are one shingle; rows that repeat a text or a key each get a row; a null key is never a
component's smallest where there are others, and a row without key is kept only if its component has none;
an empty table gives an empty table; texts are taken whole; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.llm.common import Scratch, connected_components, in_fixed_order, release

_U = np.uint64
#: A worker's table of word hashes is emptied beyond so many entries.
ENTRIES = 500_000
#: Shingles of a cell's side, each row counted as 64 at least.
CELL = 500_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def shingle_set(text: str | None, words: int = 2) -> np.ndarray:
    """The distinct 64-bit hashes, ascending, of a text's shingles; A-Z lower-cased."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.array([*map(_words.__getitem__, tokens)], np.uint64)
    size = min(words, len(hashes))
    if not size:
        return hashes
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(out)


def band_count(similarity: float, rows: int, miss: float) -> int:
    """Bands, an even number, with which a pair at the limit meets in none with probability miss at most."""
    return 2 * math.ceil(math.log(miss) / math.log(1 - similarity**rows) / 2)


def band_keys(sets: list[np.ndarray], bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """A row of keys for each set that is not empty: the first half of minima, the second of maxima."""
    rng = np.random.default_rng(seed)
    factors, shifts = (rng.integers(0, 2**63, bands * rows // 2, dtype=np.uint64) * _U(2) + _U(1) for _ in range(2))
    keys = np.empty((len(sets), bands), np.uint64)
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    for b in range(bands // 2):
        low = high = np.full(len(sets), b, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = flat * factors[k] + shifts[k]
            low, high = _mix(low ^ np.minimum.reduceat(h, starts)), _mix(high ^ np.maximum.reduceat(h, starts))
        keys[:, b], keys[:, bands // 2 + b] = low, high + _U(bands)
    return keys.view(np.int64)


def linked(sets: list[np.ndarray], roots: np.ndarray, sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the components (roots) of sets: 100 * intersection >= percent * union.

    sides: where they differ at all, only members of different sides are compared.
    """
    n = np.array([*map(len, sets)], np.int64)
    m, both = len(sets), bool(sides.any()) and not bool(sides.all())
    _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(m), n)
    token = token[np.lexsort((token, often[token], member))]  # each member's shingles, rarest first
    start = np.cumsum(n) - n
    shared = often[token] > 1
    need = (percent * n + 99) // 100
    able = np.add.reduceat(shared.astype(np.int64), start) >= need
    entry = shared & able[member] & (np.arange(len(token)) - start[member] < (n - need + 1)[member])
    order = np.argsort(token[entry], kind="stable")
    posted, holder = token[entry][order], member[entry][order]
    begin = np.searchsorted(posted, np.arange(len(often) + 1))
    parent = np.unique(roots, return_inverse=True)[1]
    mask, out = np.zeros(len(often), bool), []
    for x in np.flatnonzero(able):
        own = token[start[x] : start[x] + n[x]]
        probe = own[: n[x] - need[x] + 1]
        lists = [holder[begin[t] : begin[t + 1]] for t in probe.tolist() if begin[t + 1] - begin[t] > 1]
        if not lists:
            continue
        met = np.concatenate(lists)
        met = np.unique(met[(met > x) & (parent[met] != parent[x]) & ((sides[met] != sides[x]) | (not both))])
        met = met[100 * np.minimum(n[met], n[x]) >= percent * np.maximum(n[met], n[x])]
        if not len(met):
            continue
        mask[own] = True
        for y in met.tolist():
            if parent[y] != parent[x]:
                common = int(np.count_nonzero(mask[token[start[y] : start[y] + n[y]]]))
                if 100 * common >= percent * (int(n[x] + n[y]) - common):
                    parent[parent == parent[y]] = parent[x]
                    out.append((int(x), y))
        mask[own] = False
    return out


def _signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(row, doc_id, n, d1, d2, keys) of each row of docs (row, doc_id, text); d1 and d2 are a digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                b = whole.slice(at, 128)
                sets = [shingle_set(x.as_py(), words) for x in b.column(2)]
                digest = np.array([[*divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 2**64)] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                some = [s for s in sets if len(s)]
                flat = band_keys(some, bands, rows).reshape(-1) if some else np.zeros(0, np.int64)
                ends = np.cumsum([0, *[bands * bool(len(s)) for s in sets]])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([*map(len, sets)], pa.int64()), pa.array(np.ascontiguousarray(digest[:, 0])), pa.array(np.ascontiguousarray(digest[:, 1])), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["row", "doc_id", "n", "d1", "d2", "keys"])
        release()

    return docs.mapInArrow(run, "row long, doc_id long, n long, d1 long, d2 long, keys array<long>")


def _sets_of(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                b = whole.slice(at, 128)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(x.as_py(), words).view(np.int64) for x in b.column(1)], pa.list_(pa.int64()))], ["id", "s"])
        release()

    return docs.mapInArrow(run, "id long, s array<long>")


def _cells(buckets: DataFrame, side: int) -> DataFrame:
    """(cell, side, id, root) of buckets (key, id, n, root): each bucket dealt to cells that together hold all its
    pairs of members of different components, in sides of about that many shingles."""
    weight = F.col("n") + 64
    parts = buckets.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum(weight).alias("w"))
    known = parts.groupBy("key").agg(F.max(F.struct("m", "w", "root")).alias("top"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("c")).where("c > 1")
    n_parts = lambda w: F.ceil(w / side).cast("int")
    known = known.select("key", F.col("top.root").alias("top"), n_parts(F.col("top.w")).alias("q0"), n_parts(F.col("w") - F.col("top.w")).alias("q1"))
    rows = buckets.join(known, "key").withColumn("major", F.col("root") == F.col("top"))
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.when(F.col("major"), F.col("q0")).otherwise(F.col("q1"))).cast("int")
    rows = rows.withColumn("part", part)
    spread = lambda q: F.sequence(F.lit(0), F.col(q) - 1)
    cell = lambda kind, x, y, of: F.struct(F.lit(kind).alias("kind"), x.cast("int").alias("x"), y.cast("int").alias("y"), of.cast("int").alias("side"))
    p, zero = F.col("part"), F.lit(0)
    single = F.array(cell(0, zero, zero, zero))
    of_major = F.transform(spread("q1"), lambda j: cell(1, p, j, zero))
    of_minor = F.concat(F.transform(spread("q0"), lambda i: cell(1, i, p, F.lit(1))), F.transform(spread("q1"), lambda j: cell(2, F.least(p, j), F.greatest(p, j), F.when(p > j, 1).otherwise(0))))
    rows = rows.withColumn("c", F.explode(F.when((F.col("q0") == 1) & (F.col("q1") == 1), single).when(F.col("major"), of_major).otherwise(of_minor)))
    return rows.select(F.xxhash64("key", "c.kind", "c.x", "c.y").alias("cell"), F.col("c.side").alias("side"), "id", "root")


def _links_in(cells: DataFrame, percent: int) -> DataFrame:
    """(a, b) roots of components that a pair within the limit joins, of cells (cell, side, id, root, s)."""

    def found(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        roots, sides = t.column("root").to_numpy(), t.column("side").to_numpy()
        s = t.column("s").combine_chunks()
        ends, flat = s.offsets.to_numpy(), s.values.to_numpy()
        pairs = linked([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], roots, sides, percent)
        if pairs:
            at = np.array(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(roots[at[:, 0]]), pa.array(roots[at[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for b in batches:
            keys = b.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if y == x:
                    continue
                if keys[x] != cell and held:
                    yield from found(held)
                    held = []
                cell = keys[x]
                held.append(b.slice(x, y - x))
        if held:
            yield from found(held)
        release()

    return cells.select("cell", "side", "id", "root", "s").repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def components(plain: DataFrame, scratch: Scratch, words: int, percent: int, rows: int = 6, miss: float = 1e-6, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, n, d1, d2, ...) of each row of plain (row, doc_id, text), and (d1, d2, low, root) of each set that is
    not empty: root names its component, low is the smallest doc_id of the set."""
    bands = band_count(percent / 100, rows, miss)
    signed = scratch.keep(_signed(plain.select("row", "doc_id", "text"), words, bands, rows), "signed")
    nodes = scratch.keep(signed.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("id"), F.min("doc_id").alias("low"), F.first("n").alias("n")), "nodes")
    banded = signed.select("row", "keys").join(nodes.select(F.col("id").alias("row"), F.col("id"), "n"), "row").select(F.explode("keys").alias("key"), "id", "n")
    banded = scratch.keep(banded, "banded")
    several = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("id", "n")).alias("first")).where("m > 1").select("key", F.col("first.id").alias("a"), F.col("first.n").alias("na"))
    met = scratch.keep(banded.join(several, "key").where("id <> a"), "met")
    near = 100 * F.least("n", "na") >= percent * F.greatest("n", "na")
    asked = scratch.keep(met.where(near).select("a", F.col("id").alias("b")).distinct(), "asked")
    held = met.select(F.explode(F.array("a", "id")).alias("row")).distinct()
    sets = scratch.keep(_sets_of(plain.select("row", "text").join(held, "row").select("row", "text"), words), "sets")
    both = asked.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    stars = scratch.keep(both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "stars")
    first = scratch.keep(connected_components(stars, scratch), "first")
    # What the stars leave: buckets whose members, without the first, are of several components, each set of them once.
    root = first.select(F.col("node").alias("id"), "root")
    left = met.select("key", "id", "n").join(root, "id", "left").withColumn("root", F.coalesce("root", "id"))
    left = scratch.keep(left, "left")
    h = [F.xxhash64("id", F.lit(k)) for k in (1, 2)]
    open_ = left.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("m"), F.bit_xor(h[0]).alias("h1"), F.bit_xor(h[1]).alias("h2")).where("x <> y")
    once = open_.groupBy("m", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    cells = scratch.keep(_cells(scratch.keep(left.join(once, "key", "left_semi"), "open"), cell), "cells")
    more = scratch.keep(_links_in(cells.join(sets, "id"), percent), "more")
    second = scratch.keep(connected_components(more, scratch, tag="dd"), "second")
    named = nodes.join(root.withColumnRenamed("root", "r1"), "id", "left").withColumn("r1", F.coalesce("r1", "id"))
    named = named.join(second.select(F.col("node").alias("r1"), F.col("root").alias("r2")), "r1", "left").select("d1", "d2", "low", F.coalesce("r2", "r1").alias("root"))
    named = scratch.keep(named, "named")
    return signed, named


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 2, percent: int = 80, rows: int = 6, miss: float = 1e-6) -> DataFrame:
    """One row a row of docs: doc_id, n_shingles, component_id, kept; linked are texts with 100 * |intersection| >= percent * |union|."""
    scratch = Scratch(docs.sparkSession, "minhash")
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    plain = (plain if in_fixed_order(plain) else scratch.keep(plain, "input")).withColumn("row", F.monotonically_increasing_id())
    signed, named = components(plain, scratch, words, percent, rows, miss)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    known = scratch.keep(named.select("d1", "d2", "root").join(lowest, "root").select("d1", "d2", "component_id"), "known")
    some = signed.where("n > 0").select("doc_id", "n", "d1", "d2").join(known, ["d1", "d2"]).select("doc_id", "n", "component_id")
    out = some.unionByName(signed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
