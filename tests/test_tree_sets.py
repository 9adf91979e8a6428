"""Fitch sets at touched nodes only, against a dense walk over all nodes; batches of shared paths."""

from __future__ import annotations

import numpy as np
import pytest

from hyphalake.operators import tree


def dense(nodes, states, default):
    """masks, changes, gains and losses of one trait, node by node."""
    kids, mask, changes = {}, {}, {}
    for node, parent, *_ in nodes:
        kids.setdefault(parent, []).append(node)
    for node, parent, _, _, tip in reversed(nodes):
        below = [mask[k] for k in kids.get(node, []) if mask[k]]
        changes[node] = sum(changes[k] for k in kids.get(node, []))
        if tip is not None:
            mask[node] = sum({1 << s for x, s in states if x == tip}) or (1 << default if default is not None else 0)
        elif not below:
            mask[node] = 0
        else:
            common, every = np.bitwise_and.reduce(below), np.bitwise_or.reduce(below)
            mask[node], changes[node] = int(common or every), changes[node] + int(common == 0)
    own, gains, losses = {}, 0, 0
    for node, parent, *_ in nodes:
        least = 0 if mask[node] & 1 else 1
        own[node] = own[parent] if parent is not None and mask[node] >> own[parent] & 1 else least
        if parent is not None and mask[node]:
            gains, losses = gains + (own[node] > own[parent]), losses + (own[node] < own[parent])
    return mask, changes, gains, losses


@pytest.mark.parametrize("default", [0, 1, None])
def test_sparse_sets_are_those_of_a_dense_walk(spark, default):
    rng = np.random.default_rng(5)
    nodes = [(0, None, 0, 0.0, None)]
    for k in range(1, 60):
        parent = int(rng.integers(max(0, k - 12), k))
        nodes.append((k, parent, nodes[parent][2] + 1, 1.0, None))
    inner = {n[1] for n in nodes}
    nodes = [(*n[:4], f"t{n[0]}" if n[0] not in inner and n[0] % 9 else None) for n in nodes]
    tips = [n[4] for n in nodes if n[4]]
    rows = [(og, str(t), int(s)) for og in range(40) for t, s in zip(rng.choice(tips, og % 7), rng.integers(0, 2, og % 7))]
    edges, traits = spark.createDataFrame(nodes, tree.EDGES), spark.range(40).withColumnRenamed("id", "og")
    states = spark.createDataFrame(rows, "og long, tip string, state int")
    sets, depths = tree.downpass(edges, traits, states, default=default).collect(), tree.downpass(edges, traits, states, default=default, depth=1).collect()
    least = {r.og: r.changes for r in tree.parsimony(edges, traits, states, default=default).collect()}
    events = {r.og: (r.gains, r.losses) for r in tree.gains_and_losses(edges, traits, states, default=default).collect()}
    for og in range(40):
        mask, changes, gains, losses = dense(nodes, {(t, s) for o, t, s in rows if o == og}, default)
        want = {(n[0], n[1], mask[n[0]], changes[n[0]]) for n in nodes if mask[n[0]]}
        assert {(r.node, r.parent, r["mask"], r.changes) for r in sets if r.og == og} == want
        assert {(r.node, r.parent, r["mask"], r.changes) for r in depths if r.og == og} == {w for w in want if w[1] == 0}
        assert least[og] == changes[0] and events[og] == (gains, losses)


def test_a_wide_tree_costs_a_trait_its_own_states(spark):
    """200,000 tips were refused, and a dense walk over them holds nodes x traits."""
    tips = spark.range(1, 200_001).selectExpr("cast(id as int) as node", "0 as parent", "1 as depth", "1.0D as branch_length", "concat('t', id) as tip")
    edges = spark.createDataFrame([(0, None, 0, 0.0, None)], tree.EDGES).unionByName(tips)
    states = spark.range(1000).selectExpr("id as og", "concat('t', id + 1) as tip", "1 as state")
    out = tree.gains_and_losses(edges, spark.range(1000).withColumnRenamed("id", "og"), states)
    assert {(r.gains, r.losses) for r in out.collect()} == {(1, 0)}


def test_shared_paths_come_in_bounded_batches(spark):
    nodes = tree.parse_newick("((A:1,B:2):3,(C:1,D:1):2,E:5);")
    edges = spark.createDataFrame(nodes, tree.EDGES)
    got = {(r.i, r.j): r.v for r in tree.shared_path_lengths(edges, pairs=2).collect()}
    assert len(got) == 25 and got["A", "B"] == 3 and got["A", "C"] == 0 and got["E", "E"] == 5 and got["B", "B"] == 5
