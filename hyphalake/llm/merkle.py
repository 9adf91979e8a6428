"""Merkle manifest of a dataset by an external-memory node store.

Every row is a leaf, the digest of its columns.  The leaves of a group ascend by key; of every ``fanout``
consecutive nodes one parent is made until one node, the group's subroot, is left; the subroots, ordered
by group, are the leaves of a tree above, whose top is the root.

1. Leaves are range-sorted to runs by (group, key) and kept.  A run's start among its group's leaves is a
   sum over earlier runs' counts, so a leaf's coordinate (tree, level, place) needs no global window.
2. Level k is one folder ``level=k`` of the store, sorted by coordinate.  The next one is made by reading it
   once in order, range-partitioned by the parents' coordinates, so siblings meet without another exchange.
3. Proofs go down the levels: a level's nodes meet the paths of their own coordinates in a merge join and
   hand them on to their children, each with its siblings to the left and to the right.

Scale: texts are read once and never shuffled; a leaf sends its digests, and a level is an eighth of the one
below.  A path's length follows the logarithm of the group's size.  A group with a third of all rows is cut
to as many ranges as it fills, equal rows included, as sorting ends with the row's number.  The driver gets
the largest group's size and the root.

Recovery: every level and every level of paths is a table in the shared folder.

Defined cases: a null column counts as ``-`` and a null group as the first; a null key comes first; rows that
repeat a key ascend by digest, and equal rows are leaves of their own; a group of one row has its leaf as
subroot; a lone group's subroot is the root; a node without siblings is hashed alone; an empty table has no
rows and no root; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.llm.common import Scratch

#: Starts of runs are broadcast up to so many rows (about 100 bytes each), else joined by a shuffle.
BROADCAST_ROWS = 100_000


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(*columns: Column) -> Column:
    """Digest of columns in order: each as ``-`` where null, else its UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ranked(rows: DataFrame, by: Sequence[str], scratch: Scratch, tag: str) -> DataFrame:
    """rows (tree, ...) with pos, the place in its tree by the named columns, and n, the tree's number of rows."""
    order = ["tree", *by]
    runs = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).withColumn("run", F.shiftright("at", 33))
    runs = scratch.keep(runs, f"{tag}-runs")
    counts = runs.groupBy("tree", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("m").over(tree.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.keep(counts.select("tree", "run", (before - F.col("first")).alias("shift"), F.sum("m").over(tree).alias("n")), f"{tag}-starts")
    known = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    return runs.join(known, ["tree", "run"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def climb(leaves: DataFrame, scratch: Scratch, tag: str, fanout: int = 8) -> list[DataFrame]:
    """The levels above leaves (tree, pos, n, hash, item), each (tree, pos, n, hash, children[, items]), leaves first.

    n is the number of nodes of the tree at that level; a tree ends with the level at which it is 1.
    """
    largest = leaves.agg(F.max("n").alias("n")).first().n or 0
    levels = [leaves]
    while fanout ** (len(levels) - 1) < largest:
        first = len(levels) == 1
        below = levels[-1].where("n > 1").withColumn("up", F.expr(f"pos div {fanout}"))
        grouped = below.repartitionByRange("tree", "up").groupBy("tree", "up").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash", *["item"] * first))).alias("c"))
        up = grouped.select("tree", F.col("up").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), sha(F.array_join("c.hash", "")).alias("hash"), F.col("c.hash").alias("children"), *[F.col("c.item").alias("items")] * first)
        levels.append(scratch.keep(up.sortWithinPartitions("tree", "pos"), f"{tag}/level={len(levels)}"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash): the last node of every tree."""
    out = [x.where("n = 1").select("tree", "hash") for x in levels]
    for x in out[1:]:
        out[0] = out[0].unionByName(x)
    return out[0]


def descend(levels: list[DataFrame], above: DataFrame, scratch: Scratch, tag: str, fanout: int = 8) -> DataFrame:
    """(hash, item, subroot, path) of every leaf; above holds (tree, subroot, path) of each tree's top.

    A path goes from the leaf up; each step is (left, right), the siblings on either side in order.
    """
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        kept = ["tree", "pos", "subroot", "path", *(["hash", "item"] if k == 0 else [])]
        here = levels[k].where("n = 1").drop("n").join(above, "tree").select(kept)
        if paths is not None:
            here = here.unionByName(paths)
        if k == 0:
            return here.drop("tree", "pos")
        group = levels[k].select("tree", "pos", "children", *["items"] * (k == 1)).join(here, ["tree", "pos"])
        child = group.select("*", F.posexplode("children").alias("i", "hash"))
        step = F.struct(F.array_join(F.expr("slice(children, 1, i)"), "").alias("left"), F.array_join(F.expr(f"slice(children, i + 2, {fanout})"), "").alias("right"))
        child = child.select("tree", (F.col("pos") * fanout + F.col("i")).alias("pos"), "subroot", F.concat(F.array(step), "path").alias("path"), *(["hash", F.expr("items[i]").alias("item")] if k == 1 else []))
        paths = child if k == 1 else scratch.keep(child.sortWithinPartitions("tree", "pos"), f"{tag}-paths-{k - 1}")


def manifest(rows: DataFrame, group: str, key: str, leaf: str, carry: Sequence[str] = (), fanout: int = 8) -> DataFrame:
    """One row a row of rows: its key, leaf and carried columns, subroot, root and path.

    rows hold the leaf's digest; equal digests of one key are leaves of their own.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    plain = rows.select(F.coalesce(F.concat(F.lit("+"), F.col(group)), F.lit("")).alias("tree"), F.col(key).alias("key"), F.col(leaf).alias("hash"), F.struct(F.col(key).alias("key"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]).alias("item"), F.monotonically_increasing_id().alias("row"))
    plain = scratch.keep(plain, "read")  # sorting looks at its rows twice, and texts are to be read once
    leaves = scratch.keep(ranked(plain, ["key", "hash", "row"], scratch, "leaves").select("tree", "pos", "n", "hash", "item"), "nodes/level=0")
    levels = climb(leaves, scratch, "nodes", fanout)
    subroots = tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash", F.col("tree").alias("item"))
    upper = climb(scratch.keep(ranked(subroots, ["group"], scratch, "groups").select("tree", "pos", "n", "hash", "item"), "upper/level=0"), scratch, "upper", fanout)
    top = tops(upper).first()
    ends = upper[0].select("tree").distinct().select("tree", F.lit("").alias("subroot"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = scratch.keep(descend(upper, ends, scratch, "upper", fanout).select(F.col("item").alias("tree"), F.col("hash").alias("subroot"), "path"), "above")
    out = descend(levels, above, scratch, "nodes", fanout)
    return out.select(F.col("item.key").alias(key), F.col("hash").alias(leaf), *[F.col(f"item.c{k}").alias(c) for k, c in enumerate(carry)], "subroot", F.lit(top.hash if top else None).cast("string").alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, leaf, lambda h, x: sha(F.concat(x["left"], h, x["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level and from left to right."""
    return sha(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def tamper_report(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text", every: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: the manifest of docs against a copy in which
    the texts of keys whose CRC-32 every divides are in lower case."""
    key, own = F.col("doc_id"), [F.col(c) for c in columns]
    altered = [lower_ascii(F.col(c)) if c == text else F.col(c) for c in columns]
    chosen = F.crc32(key.cast("string").cast("binary")) % every == 0
    rows = docs.select(key, "lang", leaf_digest(*own).alias("leaf"), F.when(chosen, leaf_digest(*altered)).alias("now"))
    out = manifest(rows, "lang", "doc_id", "leaf", ["now"])
    folded = fold(F.coalesce("now", "leaf"), F.col("path"))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
