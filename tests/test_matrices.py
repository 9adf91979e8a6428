"""Blocked products, sketches, clusters and ranks against plain versions."""

from __future__ import annotations

import math
import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hyphalake.operators import burden, clusters, convergence, gram, kinship, relational


@pytest.mark.parametrize("sizes", [{}, {"block": 7, "strip_bytes": 7 * 8 * 30}])
def test_blocked_products(spark, sizes):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(30, 600))
    m[3, 5] = np.nan
    z = (m - np.nanmean(m, axis=0)) / (np.nanstd(m, axis=0) + 1e-10)
    z[np.isnan(z)] = 0
    vectors = spark.createDataFrame([(f"s{i:02d}", [None if math.isnan(x) else x for x in m[i].tolist()]) for i in range(30)], "s string, v array<double>").repartition(3)
    assert np.allclose(gram.of_vectors(vectors, "s", "v", **sizes).matrix(), z @ z.T / 600)
    held = (np.arange(30)[:, None] * np.arange(600)[None, :]) % 3 == 0
    cells = spark.createDataFrame([(f"s{i:02d}", j, float(z[i, j])) for i in range(30) for j in range(600) if held[i, j]], "sample string, pos int, z double").repartition(5)
    want = np.where(held, z, 0) @ np.where(held, z, 0).T / 600
    blocks = gram.of_sites(cells, **sizes)
    assert np.allclose(blocks.matrix(), want)
    pairs = blocks.pairs().toPandas()
    assert len(pairs) == 900 and np.allclose(pairs.pivot(index="i", columns="j", values="v").to_numpy(), want)
    rows = blocks.rows().toPandas().sort_values("at")
    assert np.allclose(np.stack(rows["row"].to_list()), want) and list(rows["i"]) == [f"s{i:02d}" for i in range(30)]
    with pytest.raises(ValueError, match="at most 20"):
        blocks.matrix(20)


def test_no_samples(spark):
    none = spark.createDataFrame([], "sample string, pos int, z double")
    assert gram.of_sites(none).pairs().count() == 0
    assert gram.of_vectors(spark.createDataFrame([], "s int, v array<double>"), "s", "v").pairs().count() == 0


def test_pairs_of_sketches_lose_none(spark):
    """Against all pairs, with a passage that most texts share and copies."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefg", k=5))
    shared = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(20, 150))]
        for _ in range(4):
            own = list(base)
            for at in rng.sample(range(len(own)), rng.randint(0, len(own) // 3)):
                own[at] = word()
            texts.append(" ".join(own) + (f" {shared}" if rng.random() < 0.7 else ""))
    texts += texts[:5] + ["short", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    sketches = kinship.kmer_sketch(df, "k", "t", 8, 200)
    sets = {r.k: set(r.sketch) for r in sketches.collect()}
    first = {}
    for k in sorted(sets):
        first.setdefault(frozenset(sets[k]), k)
    want = {}
    for a, b in combinations(sorted(sets), 2):
        fa, fb = first[frozenset(sets[a])], first[frozenset(sets[b])]
        c = len(sets[a] & sets[b])
        j = c / len(sets[a] | sets[b])
        d = max(0.0, -math.log(2 * j / (1 + j)) / 8) if c else 1.0
        if d <= 0.08 and ((fa == a and fb == b) or fb == a):
            want[a, b] = (c, round(d, 9))
    got = {(r.a, r.b): (r.shared, round(r.distance, 9)) for r in kinship.mash_pairs(sketches, "k", 8, 0.08).collect()}
    assert got == want and len(want) > 60


def sequential_clusters(near, quality):
    removed, to = set(), {}
    for x in sorted(near):
        if x not in removed:
            group = {x} | (near[x] - removed)
            best = min(group, key=lambda y: (-quality.get(y, 0), y))
            for y in group - {best}:
                to[y] = best
            removed |= group - {best}
    return {(x, to.get(x, x), x not in removed) for x in near}


@pytest.mark.parametrize("width", [2, 20])
def test_duplicate_clusters_on_a_line_equal_those_of_pairs(spark, width):
    """Random keys, keys that rise along the line (a chain over all cells), many at one place, and rows that are near nothing."""
    rng = np.random.default_rng(width)
    at = {"random": rng.integers(0, 300, 60) / 10.0, "rising": np.sort(rng.integers(0, 80, 20)) / 10.0, "one": np.full(10, 5.0), "apart": np.arange(5) * 50.0}
    rows = [(k, g, float(x), float(rng.integers(0, 5))) for k, (g, x) in enumerate([(g, x) for g, xs in at.items() for x in xs])] + [(900, None, 1.0, 1.0), (901, None, 1.0, 1.0), (902, "one", None, 9.0)]
    frame = spark.createDataFrame(rows, "key long, g string, at double, quality double")
    near = {a[0]: [b for b in rows if a[1] and a[1] == b[1] and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= 1] for a in rows}
    to: dict[int, int] = {}
    for k in sorted(near):
        free = sorted((-b[3], b[0]) for b in near[k] if b[0] not in to)
        if k not in to:
            to |= {b: free[0][1] for _, b in free[1:]}
    told = [(k, to.get(k, k), k not in to) for k, own in near.items() if len(own) > 1]
    assert sorted(kinship.duplicate_clusters_on_line(frame, ["g"], 1, width=width).collect()) == sorted(told)


@pytest.mark.parametrize("kind", ["random", "chain", "cliques"])
def test_duplicate_clusters_equal_the_sequential_rule(spark, kind):
    rng = random.Random(7)
    pairs = {"random": [(rng.randrange(80), rng.randrange(80)) for _ in range(90)], "chain": [(k, k + 1) for k in range(14)], "cliques": [(10 * g + i, 10 * g + j) for g in range(6) for i, j in combinations(range(9), 2)]}[kind]
    quality = {k: float(rng.randrange(6)) for k in range(80) if rng.random() < 0.9}
    near: dict = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    got = kinship.duplicate_clusters(spark.createDataFrame(pairs, "a int, b int"), spark.createDataFrame(list(quality.items()), "key int, quality double"))
    assert set(map(tuple, got.collect())) == sequential_clusters(near, quality)


def slow_linkage(distance):
    groups = {i: [i] for i in range(len(distance))}
    out = set()
    while len(groups) > 1:
        height, a, b = min((np.mean([distance[i, j] for i in groups[x] for j in groups[y]]), x, y) for x, y in combinations(sorted(groups), 2))
        groups[a] = groups[a] + groups.pop(b)
        out.add((a, b, round(float(height), 9)))
    return out, groups[0]


def test_chain_of_neighbours_equals_plain_linkage(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 3))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    merges, order = slow_linkage(d)
    assert {(a, b, round(h, 9)) for a, b, h in kinship.average_linkage(d)} == merges
    assert kinship.leaf_order(list(range(40)), d) == order
    table = kinship.linkage_table(spark, list(range(40)), d).toPandas()
    assert table["height"].is_monotonic_increasing and table["size"].iloc[-1] == 40
    assert kinship.leaf_order([], np.zeros((0, 0))) == [] and kinship.leaf_order(["x"], np.zeros((1, 1))) == ["x"]


def test_linkage_of_five_hundred_samples():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 4))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    live, size, merges, m = list(range(500)), np.ones(500), set(), d.copy()
    np.fill_diagonal(m, np.inf)
    while len(live) > 1:
        sub = m[np.ix_(live, live)]
        i, j = divmod(int(sub.argmin()), len(live))
        a, b = sorted((live[i], live[j]))
        merges.add((a, b, round(float(m[a, b]), 9)))
        m[a] = (m[a] * size[a] + m[b] * size[b]) / (size[a] + size[b])
        m[:, a] = m[a]
        m[a, a] = np.inf
        size[a] += size[b]
        live.remove(b)
    assert {(a, b, round(h, 9)) for a, b, h in kinship.average_linkage(d)} == merges


def test_all_numbers_of_clusters(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(20, 2)) * 0.3 + c for c in ((0, 0), (6, 0), (0, 6), (6, 6))])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    long = spark.createDataFrame([(i, j, float(d[i, j])) for i in range(80) for j in range(80) if i != j], "i int, j int, v double")
    rows = clusters.distance_rows(long)
    assert np.allclose(np.stack(rows.toPandas().sort_values("at")["row"].to_list()), d)
    given, inertia = clusters.kmeans(rows, range(2, 8))
    table = given.toPandas()
    s = {r.k: r.silhouette for r in clusters.silhouettes(rows, given).collect()}
    for k, g in table.groupby("k"):
        c = g.sort_values("at")["cluster"].to_numpy()
        assert sorted(set(c)) == list(range(k)) and c[0] == 0
        centres = np.stack([d[c == q].mean(axis=0) for q in range(k)])
        assert inertia[k] == pytest.approx(((d - centres[c]) ** 2).sum(), rel=1e-6)
        want = []
        for i in range(80):
            own = d[i][(c == c[i]) & (np.arange(80) != i)]
            other = min(d[i][c == q].mean() for q in range(k) if q != c[i])
            want.append((other - own.mean()) / max(other, own.mean()) if len(own) else 0.0)
        assert s[k] == pytest.approx(np.mean(want))
        pairs = long.union(spark.createDataFrame([(0, 0, 0.0)], "i int, j int, v double"))
        if k == 4:
            own = given.where("k = 4").select("i", "cluster")
            assert kinship.silhouette(pairs, own).first().silhouette == pytest.approx(s[4])
    choice = clusters.cluster_choice(rows, range(2, 8)).toPandas()
    assert choice["chosen"].sum() == 1 and choice.loc[choice["chosen"], "k"].iloc[0] == 4


def plain_bh(p):
    order = np.argsort(-p)
    q, low = np.empty(len(p)), 1.0
    for place, at in enumerate(order):
        low = min(low, p[at] * len(p) / (len(p) - place))
        q[at] = low
    return q


def test_q_values_and_ranks_in_parts(spark):
    """Enough tests that the range of p is cut, with ties, nulls and groups of one test."""
    rng = np.random.default_rng(9)
    p = np.round(rng.beta(0.5, 2, 9000), 4)
    by = np.where(rng.random(9000) < 0.7, "hot", rng.choice(["x", "y"], 9000)).astype(object)
    by[0] = None
    rows = [(i, b, float(x)) for i, (b, x) in enumerate(zip(by, p))] + [(9000, "hot", None)]
    df = spark.createDataFrame(rows, "i int, layer string, pvalue double").repartition(4)
    assert len(relational.cut_points(df.select("pvalue").distinct(), "pvalue")) >= 3
    got = {r.i: r.qvalue for r in relational.bh_qvalues(df).collect()}
    assert got.pop(9000) is None and np.allclose([got[i] for i in range(9000)], plain_bh(p))
    layered = {r.i: r.qvalue for r in relational.bh_qvalues(df, by=["layer"]).collect()}
    for b in ("hot", "x", "y", None):
        at = [i for i in range(9000) if by[i] == b]
        assert np.allclose([layered[i] for i in at], plain_bh(p[at]))
    ranks = {r.i: r.rank for r in relational.average_ranks(df.where("pvalue is not null"), "pvalue", "rank").collect()}
    assert np.allclose([ranks[i] for i in range(9000)], pd.Series(p).rank())
    grouped = relational.average_ranks(df.where("pvalue is not null"), "pvalue", "rank", ["layer"]).where(F.col("layer").isNull()).collect()
    assert [r.rank for r in grouped] == [1.0]


def plain_mixed_model(y, x, k):
    """Maximum likelihood of the ratio of variances on a fine grid, without an eigenbasis."""
    n = len(y)

    def parts(log_delta):
        v = k + math.exp(log_delta) * np.eye(n)
        inv = np.linalg.inv(v)
        b = np.linalg.solve(x.T @ inv @ x, x.T @ inv @ y)
        r = y - x @ b
        s2 = r @ inv @ r / n
        return 0.5 * (n * math.log(2 * math.pi * s2) + np.linalg.slogdet(v)[1] + n), b, s2 * np.linalg.inv(x.T @ inv @ x)

    grid = np.linspace(-8, 8, 161)
    best = grid[int(np.argmin([parts(g)[0] for g in grid]))]
    fine = np.linspace(best - 0.1, best + 0.1, 401)
    best = min(max(fine[int(np.argmin([parts(g)[0] for g in fine]))], -8), 8)
    _, b, cov = parts(best)
    return b[-1], math.sqrt(cov[-1, -1]), 1 / (1 + math.exp(best))


def test_burden_under_kinship(spark):
    rng = np.random.default_rng(12)
    rows, pairs, want = [], [], {}
    for g, n in (("x", 40), ("y", 55)):
        z = rng.normal(size=(n, 80))
        k = z @ z.T / 80 * 3
        names = [f"{g}{i:02d}" for i in range(n)]
        case = rng.integers(0, 2, n)
        y = 30 * np.exp(np.linalg.cholesky(k / 3 + 1e-6 * np.eye(n)) @ rng.normal(size=n) * 0.4 + 0.3 * case)
        rows += [(g, s, float(b), int(c)) for s, b, c in zip(names, y, case)]
        pairs += [(a, b, float(k[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
        want[g] = plain_mixed_model(np.log1p(y), np.column_stack((np.ones(n), case)), k / np.mean(np.diag(k)))
    pairs += [("x00", "y00", 9.0), ("y00", "x00", 9.0)]  # other groups' cells do not meet
    rows.append(("x", "no kinship", 5.0, 1))
    frame, k = spark.createDataFrame(rows, "species string, sample string, burden double, is_case int"), spark.createDataFrame(pairs, "i string, j string, v double")
    got = {r.species: r for r in burden.burden_models(frame, ["species"], k).collect()}
    for g, (beta, se, h2) in want.items():
        assert got[g].beta == pytest.approx(beta, rel=1e-3) and got[g].se == pytest.approx(se, rel=1e-2) and got[g].h2 == pytest.approx(h2, abs=5e-3)
    control = {r.species: r for r in burden.kinship_control(frame, ["species"], k).collect()}
    plain = {r.species: r for r in burden.burden_models(frame.where("sample <> 'no kinship'"), ["species"]).collect()}
    assert all(control[g].naive_p == pytest.approx(plain[g].pvalue) and control[g].kinship_p == pytest.approx(got[g].pvalue) and control[g].both_p is None for g in "xy")


def test_heavy_items_and_similar_sets(spark):
    rng = random.Random(1)
    members = [(g, i) for g in range(60) for i in {0, 1, *rng.choices(range(40), k=rng.randint(3, 12))}]
    sets: dict = {}
    for g, i in members:
        sets.setdefault(g, set()).add(i)
    df = spark.createDataFrame(members + members[:9], "g int, i int")
    for least in (0.0, 0.3, 0.6):
        want = {(a, b, len(sets[a] & sets[b]), round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9)) for a, b in combinations(sorted(sets), 2) if sets[a] & sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9}
        for heavy in (5, 1000):
            assert {(r.a, r.b, r.shared, round(r.jaccard, 9)) for r in relational.jaccard_by_pair(df, "g", "i", least, heavy).collect()} == want
    rows = spark.createDataFrame([(g % 3, g, i) for g, i in members], "species int, family int, og int")
    between = {(r.family_a, r.family_b): r.n_shared for r in convergence.shared_between_families(rows, heavy=7).collect()}
    assert between == {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a % 3 < b % 3 and sets[a] & sets[b]}


@pytest.mark.parametrize("n, size", [(5000, 40), (30, 29), (30, 50), (0, 3)])
def test_random_sets_are_the_smallest_digests(spark, n, size):
    import hashlib

    got: dict = {}
    for r in convergence.random_sets(spark.range(n).select(F.col("id").alias("og")), size, 7, "s").collect():
        got.setdefault(r.perm, set()).add(r.og)
    want = {p: set(sorted(range(n), key=lambda i: hashlib.md5(f"s|{p}|{i}".encode()).hexdigest())[:size]) for p in range(7)}
    assert got == {p: x for p, x in want.items() if x}


@pytest.mark.parametrize("places", [20_000_000, 30])
def test_rarefaction_in_blocks_of_orders(spark, places):
    from hyphalake.operators import pangenome

    rng = random.Random(3)
    has = {f: {g for g in range(12) if f < 3 or rng.random() < 0.4} or {0} for f in range(40)}
    pav = spark.createDataFrame([(f, g) for f, x in has.items() for g in x], "og int, genome int")
    order: dict = {}
    for r in pangenome.genome_orders(pav.select("genome"), "genome", 7).orderBy("perm", "pos").collect():
        order.setdefault(r.perm, []).append(r.genome)
    got = {(r.perm, r.n): (r.pan, r.core) for r in pangenome.rarefaction(pav, 7, places=places).collect()}
    assert got == {(p, n): (sum(bool(x & set(o[:n])) for x in has.values()), sum(set(o[:n]) <= x for x in has.values())) for p, o in order.items() for n in range(1, 13)}


def test_shared_counts_by_squares_shuffle_no_pairs(spark, monkeypatch):
    """Blocks of 4 of 30 groups, one item in all of them, keys of text; pairs of rows are not met."""
    import itertools
    import random

    from hyphalake.operators import relational

    rng = random.Random(4)
    rows = [(f"g{g:02}", rng.randrange(60)) for g in range(30) for _ in range(12)] + [(f"g{g:02}", 99) for g in range(30)] + [(None, 99), ("g01", None), ("alone", 500)]
    monkeypatch.setattr(relational, "item_pairs", lambda *a: (_ for _ in ()).throw(AssertionError("pairs are shuffled")))
    monkeypatch.setattr(relational, "SIDE", 4)
    monkeypatch.setattr(relational, "PAIRS", 7)
    sets = {}
    for g, i in rows:
        if g is not None:
            sets.setdefault(g, set()).add(i)
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len((sets[a] & sets[b]) - {None})
        if shared:
            want[a, b] = (shared, round(shared / (len(sets[a]) + len(sets[b]) - shared), 9))
    got = relational.jaccard_by_pair(spark.createDataFrame(rows, "g string, i int"), "g", "i").collect()
    assert {(r.a, r.b): (r.shared, round(r.jaccard, 9)) for r in got} == want and len(got) == len(want)
