"""Trees as edge tables: Newick, path lengths, covariances and parsimony for many traits at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.sources.shared import kept

EDGES = "node int, parent int, depth int, branch_length double, tip string"


def parse_newick(text: str) -> list[tuple[int, int | None, int, float, str | None]]:
    """(node, parent, depth, branch length, tip) in preorder; quoted labels and inner labels are understood."""
    nodes: list[list] = [[0, None, 0, 0.0, None]]
    inner = {0}
    at, stack, i, n = 0, [0], 0, len(text)

    def child(parent: int) -> int:
        nodes.append([len(nodes), parent, nodes[parent][2] + 1, 0.0, None])
        return len(nodes) - 1

    while i < n and text[i] != ";":
        c = text[i]
        if c == "(":
            inner.add(at)
            stack.append(at)
            at = child(at)
            i += 1
        elif c == ",":
            at = child(stack[-1])
            i += 1
        elif c == ")":
            at = stack.pop()
            i += 1
        elif c == ":":
            j = i + 1
            while j < n and text[j] not in ",();[":
                j += 1
            nodes[at][3] = float(text[i + 1 : j].strip() or 0)
            i = j
        elif c == "[":
            i = text.find("]", i) + 1 or n
        elif c.isspace():
            i += 1
        else:
            if c == "'":
                j = text.find("'", i + 1)
                label, i = text[i + 1 : j], j + 1
            else:
                j = i
                while j < n and text[j] not in ",():;[":
                    j += 1
                label, i = text[i:j].strip(), j
            if at not in inner:
                nodes[at][4] = label
    return [tuple(x) for x in nodes]


def tree_table(spark: SparkSession, newick: str) -> DataFrame:
    """The edge table; a tree is one file and is parsed on the driver."""
    return spark.createDataFrame(parse_newick(newick), EDGES)


def _of_tips(edges: DataFrame, schema: str, made: Callable[[Walk, np.ndarray], Iterator[pa.RecordBatch]], rows: int = 64) -> DataFrame:
    """made(tree, numbers of tips) of every tip, some at a time; the tree is at hand in every task."""
    walk = Walk(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.array([walk.tips[t] for t in b.column(0).to_pylist()], np.int64)
            for k in range(0, len(at), rows):
                yield from made(walk, at[k : k + rows])

    tips = edges.where("tip is not null").select("tip").distinct()
    spread = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tips.repartition(spread, "tip").mapInArrow(run, schema)


def tip_paths(edges: DataFrame) -> DataFrame:
    """(tip, node, depth, cum): every node from the root to each tip with the length up to it; any depth takes one pass."""

    def made(walk: Walk, tips: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, nodes = [], []
        for t in tips.tolist():
            path, at = [], t
            while at >= 0:
                path.append(at)
                at = walk.above[at]
            names += [walk.name[t]] * len(path)
            nodes += path[::-1]
        at = np.array(nodes, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.array(walk.node, np.int32)[at]), pa.array(np.array(walk.depth, np.int32)[at]), pa.array(walk.cum[at])], ["tip", "node", "depth", "cum"])

    return _of_tips(edges, "tip string, node int, depth int, cum double", made)


#: Levels of a tree that are columns of a plan at most, pairs that a task makes, and tips that are sent to all tasks at most.
LEVELS, TASK, SENT = 16, 1 << 24, 200_000


def shared_path_lengths(edges: DataFrame, pairs: int = 1 << 18) -> DataFrame:
    """(i, j, v): length of the path that two tips share from the root, the covariance of Brownian motion.

    Each tip has its ancestor at every level as a column; two tips share the path to the last level whose ancestors agree,
    so pairs are made and written by compiled code, some tips with all others in a task.  Trees of more than LEVELS levels
    are walked instead.
    """
    walk = Walk(edges)
    at = np.array(list(walk.tips.values()), np.int64)
    steps = []
    while (at >= 0).any():
        steps.append(at)
        at = np.where(at >= 0, walk.above[at], -1)
    if not steps or len(steps) > LEVELS:
        return _walked_path_lengths(edges, pairs)
    path = np.full((len(at), len(steps)), -1)
    length = sum(s >= 0 for s in steps)
    for k, s in enumerate(steps):
        there = np.flatnonzero(s >= 0)
        path[there, length[there] - 1 - k] = s[there]
    levels = range(len(steps))
    upto = np.where(path >= 0, walk.cum[path], 0.0)
    table = pa.table({"i": pa.array(list(walk.tips), pa.string())} | {f"a{k}": pa.array(path[:, k].astype(np.int32)) for k in levels} | {f"c{k}": pa.array(np.ascontiguousarray(upto[:, k])) for k in levels})
    spark, n = edges.sparkSession, len(at)
    tips = spark.createDataFrame(table)
    own = tips.repartition(min(n, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * n // TASK)))
    other = tips.select(F.col("i").alias("j"), *[F.col(f"a{k}").alias(f"b{k}") for k in levels])
    other = F.broadcast(other) if n <= SENT else other.hint("shuffle_replicate_nl")
    v = F.lit(0.0)
    for k in levels:
        v = F.when((F.col(f"a{k}") == F.col(f"b{k}")) & (F.col(f"a{k}") >= 0), F.col(f"c{k}")).otherwise(v)
    return own.crossJoin(other).select("i", "j", v.alias("v"))


def _walked_path_lengths(edges: DataFrame, pairs: int) -> DataFrame:
    """shared_path_lengths of deep trees.

    For some tips at a time, every node takes the length up to where it leaves their paths, which is its own
    on a path and its parent's elsewhere: one pass down the tree, and no join.  Batches hold ``pairs`` pairs at most.
    """

    def made(walk: Walk, tips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        others = np.array(list(walk.tips.values()))
        on = np.zeros((len(walk.node), len(tips)), bool)
        for k, at in enumerate(tips.tolist()):
            while at >= 0:
                on[at, k] = True
                at = walk.above[at]
        v = np.zeros(on.shape)
        for level in walk.levels:
            v[level] = np.where(on[level], walk.cum[level][:, None], v[walk.above[level]])
        return others, v[others].T

    def run(walk: Walk, tips: np.ndarray) -> Iterator[pa.RecordBatch]:
        others, v = made(walk, tips)
        names = pa.array([walk.name[t] for t in others.tolist()], pa.string())
        for t, own in zip(tips.tolist(), v):
            name = pa.array([walk.name[t]], pa.string())
            for k in range(0, len(own), pairs):
                part = names.slice(k, pairs)
                yield pa.RecordBatch.from_arrays([name.take(pa.array(np.zeros(len(part), np.int64))), part, pa.array(np.ascontiguousarray(own[k : k + pairs]))], ["i", "j", "v"])

    return _of_tips(edges, "i string, j string, v double", run)


def scaled_by_diagonal(pairs: DataFrame) -> DataFrame:
    """(i, j, v) over the mean of its diagonal."""
    d = pairs.where("i = j").agg(F.avg("v").alias("_d"))
    return pairs.join(F.broadcast(d)).select("i", "j", (F.col("v") / F.col("_d")).alias("v"))


class Node(NamedTuple):
    node: int
    parent: int | None
    depth: int
    tip: str | None
    branch_length: float | None


class Walk:
    """A tree as arrays, for all traits of a batch at once: nodes in preorder, children by node, tips by name."""

    def __init__(self, edges: DataFrame, most: int = 5_000_000):
        table = edges.select("node", "parent", "depth", "tip", "branch_length").orderBy("depth", "node").limit(most + 1).toArrow()
        rows = list(map(Node, *[c.to_pylist() for c in table.columns]))
        if len(rows) > most:
            raise ValueError(f"the tree has more than {most} nodes")
        self.place = {r.node: k for k, r in enumerate(rows)}
        self.node, self.depth = [r.node for r in rows], [r.depth for r in rows]
        self.parent = [r.parent for r in rows]
        self.tips = {r.tip: k for k, r in enumerate(rows) if r.tip is not None}
        self.kids: list[list[int]] = [[] for _ in rows]
        for k, r in enumerate(rows):
            if r.parent is not None:
                self.kids[self.place[r.parent]].append(k)
        self.name = {k: t for t, k in self.tips.items()}
        #: Places of the parents, -1 above the root, of the nodes of each level, and lengths from the root.
        self.above = np.array([-1 if p is None else self.place[p] for p in self.parent], np.int64)
        self.levels = np.split(np.arange(len(rows)), np.flatnonzero(np.diff(self.depth)) + 1) if rows else []
        self.cum = np.array([r.branch_length or 0.0 for r in rows])
        for level in self.levels[1:]:
            self.cum[level] += self.cum[self.above[level]]

    def down(self, states: list[list[dict]], default: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(masks, changes), each nodes x traits, from the tips' states of every trait; a mask of 0 knows nothing."""
        masks, changes = np.zeros((len(self.node), len(states)), np.int64), np.zeros((len(self.node), len(states)), np.int64)
        for k, own in enumerate(states):
            for s in own:
                at = self.tips.get(s["tip"])
                if at is not None:
                    masks[at, k] |= 1 << s["state"]
        if default is not None:
            tips = list(self.tips.values())
            masks[tips] = np.where(masks[tips] == 0, 1 << default, masks[tips])
        for n in range(len(self.node) - 1, -1, -1):
            if self.kids[n]:
                below = masks[self.kids[n]]
                known = below != 0
                common, every = np.bitwise_and.reduce(np.where(known, below, -1), axis=0), np.bitwise_or.reduce(below, axis=0)
                clash = known.any(axis=0) & (common == 0)
                masks[n] = np.where(clash | ~known.any(axis=0), every, common)
                changes[n] = changes[self.kids[n]].sum(axis=0) + clash
        return masks, changes

    def changes(self, present: np.ndarray) -> np.ndarray:
        """Least changes of binary traits, from a row for each tip (in the order of tips) with a flag for each trait.

        Two planes of bits, one for each state, hold the sets of all traits at a node.
        """
        m = present.shape[1]
        bits = np.packbits(present, axis=1)
        every = np.packbits(np.ones(m, bool))
        planes: dict[int, tuple[np.ndarray, np.ndarray]] = {at: (~bits[k] & every, bits[k]) for k, at in enumerate(self.tips.values())}
        out = np.zeros(m, np.int64)
        for n in range(len(self.node) - 1, -1, -1):
            below = [planes.pop(k) for k in self.kids[n] if k in planes]
            if below:
                (absent, some), *rest = below
                any_absent, any_some = absent, some
                for x, y in rest:
                    absent, some, any_absent, any_some = absent & x, some & y, any_absent | x, any_some | y
                clash = ~(absent | some) & every
                planes[n] = absent | clash & any_absent, some | clash & any_some
                if rest:
                    out += np.unpackbits(clash, count=m)
        return out


class Level(NamedTuple):
    """Nodes of one level that a state is at or below, by trait: traits, places, masks, changes, and the parent's entry a level above."""

    trait: np.ndarray
    place: np.ndarray
    mask: np.ndarray
    changes: np.ndarray
    parent: np.ndarray


class Sets:
    """Fitch sets of many traits, only at nodes that have a tip with a state at or below them.

    All other nodes have the set they have where no tip has a state (``base``), so a trait costs its states times the
    tree's depth, whatever the number of tips.  Nodes of a level meet by trait and parent in sorted runs.
    """

    def __init__(self, walk: Walk, default: int | None):
        n = len(walk.node)
        self.default, self.above = default, walk.above
        self.level = np.zeros(n, np.int64)
        for k in range(n):
            if walk.above[k] >= 0:
                self.level[k] = self.level[walk.above[k]] + 1
        self.depth, self.node = np.array(walk.depth, np.int64), np.array(walk.node, np.int64)
        self.base = walk.down([[]], default)[0][:, 0] if n else np.zeros(0, np.int64)
        self.leaf = np.array([not k for k in walk.kids], bool)
        #: How many children of each node have a set where no tip has a state.
        self.known = np.bincount(walk.above[(walk.above >= 0) & (self.base != 0)], minlength=n)

    def down(self, trait: np.ndarray, place: np.ndarray, state: np.ndarray) -> list[Level]:
        """Levels from the root on, from the states of tips (trait, place, state)."""
        n = max(len(self.above), 1)
        keep = self.leaf[place]
        key, mask = trait[keep] * n + place[keep], np.left_shift(1, state[keep])
        order = np.argsort(key, kind="stable")
        key, mask = key[order], mask[order]
        cut = np.flatnonzero(np.diff(key, prepend=-1))
        key, mask = key[cut], np.bitwise_or.reduceat(mask, cut) if len(cut) else mask
        at = self.level[key % n]
        out: list[Level] = []
        up = key[:0], mask[:0], mask[:0]
        for depth in range(int(at.max()) if len(at) else 0, -1, -1):
            own = at == depth
            key_, mask_, changes = np.concatenate((up[0], key[own])), np.concatenate((up[1], mask[own])), np.concatenate((up[2], np.zeros(own.sum(), np.int64)))
            t, p = key_ // n, key_ % n
            if depth == 0:
                out.append(Level(t, p, mask_, changes, np.zeros(len(t), np.int64)))
                break
            above = t * n + self.above[p]
            run = np.argsort(above, kind="stable")
            if out:  # the level below met its parents before they were sorted
                sorted_to = np.empty(len(run), np.int64)
                sorted_to[run] = np.arange(len(run))
                out[-1] = out[-1]._replace(parent=sorted_to[out[-1].parent])
            t, p, mask_, changes, above = t[run], p[run], mask_[run], changes[run], above[run]
            first = np.flatnonzero(np.diff(above, prepend=-1))
            known = mask_ != 0
            common, every = np.bitwise_and.reduceat(np.where(known, mask_, -1), first), np.bitwise_or.reduceat(mask_, first)
            some, total = np.logical_or.reduceat(known, first), np.add.reduceat(changes, first)
            if self.default is not None:
                rest = self._rest(above[first] % n, p, first) > 0
                own_ = 1 << self.default
                common, every, some = np.where(rest, common & own_, common), np.where(rest, every | own_, every), some | rest
            clash = some & (common == 0)
            out.append(Level(t, p, mask_, changes, np.cumsum(np.diff(above, prepend=-1) != 0) - 1))
            up = above[first], np.where(clash | ~some, every, common), total + clash
        return out[::-1]

    def _rest(self, parents: np.ndarray, places: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many children with a set of their own, but no state at or below them, each parent of a level has."""
        return self.known[parents] - np.add.reduceat((self.base[places] != 0).astype(np.int64), first)

    def events(self, levels: list[Level], m: int) -> tuple[np.ndarray, np.ndarray]:
        """(gains, losses) of each of m binary traits: a node takes its parent's state where its set holds it, else its smallest."""
        gains, losses = np.zeros(m, np.int64), np.zeros(m, np.int64)
        own = np.zeros(0, np.int64)
        for depth, x in enumerate(levels):
            least = np.where(x.mask & 1, 0, 1)
            if depth == 0:
                own = least
                continue
            above = own[x.parent]
            now = np.where(x.mask >> above & 1, above, least)
            known = x.mask != 0
            gains += np.bincount(x.trait[known & (now > above)], minlength=m)
            losses += np.bincount(x.trait[known & (now < above)], minlength=m)
            if self.default is not None and len(x.trait):
                first = np.flatnonzero(np.diff(x.parent, prepend=-1))
                rest, above = self._rest(self.above[x.place[first]], x.place, first), above[first]
                d = 1 << self.default
                other = np.where(d >> above & 1, above, 0 if d & 1 else 1)
                np.add.at(gains, x.trait[first], rest * (other > above))
                np.add.at(losses, x.trait[first], rest * (other < above))
            own = now
        return gains, losses


def _by_trait(walk: Walk, traits: DataFrame, states: DataFrame, trait: str) -> DataFrame:
    """(trait, places, states): the tips' states of each trait in one row, which the number of tips bounds."""
    tips = pa.table({"_tip": pa.array(list(walk.tips), pa.string()), "_at": pa.array(list(walk.tips.values()), pa.int32())})
    places = F.broadcast(traits.sparkSession.createDataFrame(tips))
    known = states.join(places, F.col("tip") == F.col("_tip")).where(F.col("state").isNotNull())
    held = known.groupBy(trait).agg(F.collect_list(F.struct("_at", F.col("state").cast("int").alias("state"))).alias("s"))
    empty = F.array().cast("array<int>")
    return traits.select(trait).distinct().join(held, trait, "left").select(trait, F.coalesce("s._at", empty).alias("at"), F.coalesce("s.state", empty).alias("state"))


def _walked(edges: DataFrame, traits: DataFrame, states: DataFrame, trait: str, default: int | None, schema: str, made: Callable[[Sets, list[Level], int], dict], rows: int = 1024, cells: int = 1 << 20) -> DataFrame:
    """One pass over the traits with the tree at hand; made gives columns after the trait, as arrays by trait and row.

    A piece has ``rows`` traits and ``cells`` states at most, or one trait."""
    walk = Walk(edges)
    sets = Sets(walk, default)
    kind = dict(traits.dtypes)[trait]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column(1).value_lengths().to_numpy()
            ends = np.concatenate(([0], np.cumsum(size)))
            at = 0
            while at < len(b):
                stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, ends[at] + cells, "right")) - 1))
                part = b.slice(at, stop - at)
                place, state = (part.column(k).flatten().to_numpy().astype(np.int64) for k in (1, 2))
                levels = sets.down(np.repeat(np.arange(len(part)), size[at:stop]), place, state)
                columns = made(sets, levels, len(part))
                which = columns.pop("_trait")
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which)), *map(pa.array, columns.values())], [trait, *columns])
                at = stop

    return _by_trait(walk, traits, states, trait).mapInArrow(run, f"{trait} {kind}, {schema}")


def downpass(edges: DataFrame, traits: DataFrame, states: DataFrame, trait: str = "og", default: int | None = None, depth: int | None = None) -> DataFrame:
    """(trait, node, depth, parent, mask, changes): Fitch sets of all traits, from the tips to the root, or of the nodes of one depth.

    states: (trait, tip, state) with states numbered from 0; a set is a bit mask.  At a node the sets of
    all its children meet: their common bits, or all their bits and one change if there are none.  A tip
    without a row has the default state, or none and takes no part.  The tree is one file and goes to
    every task; a trait's states are one row, so any depth takes one pass.  With a default every node has a
    row for each trait: ask for a depth where that is all that is wanted.
    """

    def made(sets: Sets, levels: list[Level], m: int) -> dict:
        chosen = np.arange(len(sets.node)) if depth is None else np.flatnonzero(sets.depth == depth)
        number = np.full(len(sets.node), -1, np.int64)
        number[chosen] = np.arange(len(chosen))
        masks, changes = np.repeat(sets.base[chosen][:, None], m, axis=1), np.zeros((len(chosen), m), np.int64)
        for x in levels:
            own = number[x.place] >= 0
            masks[number[x.place[own]], x.trait[own]], changes[number[x.place[own]], x.trait[own]] = x.mask[own], x.changes[own]
        n, t = np.nonzero(masks)
        at = chosen[n]
        parent = np.where(sets.above[at] >= 0, sets.node[sets.above[at]], 0)
        return {"_trait": t, "node": sets.node[at].astype(np.int32), "depth": sets.depth[at].astype(np.int32), "parent": pa.array(parent.astype(np.int32), mask=sets.above[at] < 0), "mask": masks[n, t], "changes": changes[n, t]}

    # All nodes of a piece of traits are at hand at once.
    rows = 1024 if depth is not None else max(1, min(1024, (1 << 21) // max(1, edges.count())))
    return _walked(edges, traits, states, trait, default, "node int, depth int, parent int, mask long, changes long", made, rows)


def parsimony(edges: DataFrame, traits: DataFrame, states: DataFrame, trait: str = "og", default: int | None = 0) -> DataFrame:
    """(trait, changes): least number of state changes of each trait."""

    def made(sets: Sets, levels: list[Level], m: int) -> dict:
        changes = np.zeros(m, np.int64)
        if levels:
            changes[levels[0].trait] = levels[0].changes
        return {"_trait": np.arange(m), "changes": changes}

    return _walked(edges, traits, states, trait, default, "changes long", made)


def gains_and_losses(edges: DataFrame, traits: DataFrame, states: DataFrame, trait: str = "og", default: int | None = 0) -> DataFrame:
    """(trait, gains, losses) of binary traits: the up pass gives each node its parent's state where its set
    holds it, else its own smallest; the root takes absence where it can."""

    def made(sets: Sets, levels: list[Level], m: int) -> dict:
        gains, losses = sets.events(levels, m)
        return {"_trait": np.arange(m), "gains": gains, "losses": losses}

    return _walked(edges, traits, states, trait, default, "gains long, losses long", made)


def fitch_changes(nodes: list[tuple], state: dict[str, int]) -> int:
    """Changes of one trait on parse_newick's rows, for permutations."""
    sets: dict[int, int] = {}
    changes = 0
    for node, parent, _, _, tip in reversed(nodes):
        own = sets.pop(node, None)
        if tip is not None and tip in state:
            mask = 1 << state[tip]
        elif own is None:
            continue
        else:
            mask = own[0] if own[0] else own[1]
            changes += own[0] == 0
        if parent is not None:
            c, e = sets.get(parent, (-1, 0))
            sets[parent] = (c & mask, e | mask)
    return changes


#: Random numbers drawn at a time, and blocks of shuffles a task.
DRAWN, BLOCKS = 1 << 22, 4


def clumping(edges: DataFrame, traits: DataFrame, states: DataFrame, trait: str = "og", n_perm: int = 1000, seed: int = 42, block: int = 256) -> DataFrame:
    """(trait, observed, n_present, random_mean, clumped, D, p_random, p_brownian) of binary traits, absence where a tip has no row.

    D = (changes - clumped) / (mean of shuffles - clumped), where clumped = n1 n0 / (2 n); p_random and
    p_brownian are the shares of shuffles with at most and at least the observed changes.  A trait of one
    class only has neither, and D is 0 where shuffles are clumped as well.

    Shuffling a trait depends on its number of present tips alone, so the null is made once for each number
    that occurs: at most one for each tip, whatever the number of traits.  Shuffles of a block are bits that
    walk down the tree together; a block's draws depend on seed, number and block, so they repeat anywhere.
    A task takes a few blocks, and draws DRAWN numbers or one shuffle at a time.
    """
    walk = Walk(edges)
    n = len(walk.tips)
    tips = edges.where("tip is not null").select("tip").distinct()
    present = states.where("state = 1").join(F.broadcast(tips), "tip", "left_semi").groupBy(trait).agg(F.countDistinct("tip").alias("n_present"))
    seen = parsimony(edges, traits, states, trait).join(present, trait, "left").select(trait, F.col("changes").alias("observed"), F.coalesce("n_present", F.lit(0)).cast("long").alias("n_present"))
    seen = kept(seen, "observed")
    blocks = -(-n_perm // block)
    todo = seen.where((F.col("n_present") > 0) & (F.col("n_present") < n)).select("n_present").distinct().select("n_present", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for n1, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                m = min(block, n_perm - b * block)
                rng, few = np.random.default_rng([seed, n1, b]), max(1, DRAWN // n)
                has = np.zeros((n, m), bool)
                for at in range(0, m, few):
                    drawn = rng.random((min(few, m - at), n))
                    order = np.argpartition(drawn, n1 - 1, axis=1)[:, :n1]
                    has[order.T, np.arange(at, at + len(drawn))] = True
                value, count = np.unique(walk.changes(has), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), n1)), pa.array(value), pa.array(count)], ["n_present", "changes", "c"])

    # A block's time is in the tree, not in its row, so the number of tasks is given: adaptive execution would join them.
    tasks = max(1, min(2000, -(-todo.count() // BLOCKS)))
    null = todo.repartition(tasks, "n_present", "b").mapInArrow(run, "n_present long, changes long, c long")
    null = null.groupBy("n_present", "changes").agg(F.sum("c").alias("c")).groupBy("n_present").agg(F.collect_list(F.struct("changes", "c")).alias("h"))
    total = lambda f: F.aggregate("h", F.lit(0.0), lambda t, x: t + f(x)) / n_perm
    share = lambda keep: total(lambda x: F.when(keep(x["changes"]), x["c"]).otherwise(F.lit(0)).cast("double"))
    out = seen.join(null, "n_present", "left").withColumn("random_mean", total(lambda x: (x["changes"] * x["c"]).cast("double"))).withColumn("clumped", F.when(F.col("h").isNotNull(), F.col("n_present") * (n - F.col("n_present")) / F.lit(2.0 * max(n, 1))))
    gap = F.col("random_mean") - F.col("clumped")
    d = F.when(F.abs(gap) < 1e-10, 0.0).otherwise((F.col("observed") - F.col("clumped")) / gap)
    return out.select(trait, "observed", "n_present", "random_mean", "clumped", d.alias("D"), share(lambda c: c <= F.col("observed")).alias("p_random"), share(lambda c: c >= F.col("observed")).alias("p_brownian"))
