"""Jobs that were refused or outgrew the disk beyond some number of samples."""

from __future__ import annotations

import numpy as np
import pytest
from test_sizes import asked


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 1, (40, 6)) for c in ([0] * 6, [3, 0, 3, 0, 3, 0], [-3, 3, 0, 0, 0, -3])])
    rows = [(int(k * 7 % 120), v.tolist()) for k, v in enumerate(x)]
    rows[5], rows[6], rows[7] = (rows[5][0], [1.0, None, float("nan"), 2.0]), (rows[6][0], None), (rows[7][0], rows[8][1])
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").cache()


def test_clusters_of_vectors_are_those_of_their_distance_rows(spark, monkeypatch, vectors):
    from hyphalake.operators import clusters, gram
    from hyphalake.plans.statistics import distances
    from test_sizes import Given

    rows = distances(Given(spark, embeddings=vectors))
    want = {r.i: r.cluster for r in clusters.kmeans(rows, [4])[0].collect()}
    choice = clusters.cluster_choice(rows).toPandas()
    monkeypatch.setattr(gram, "SAMPLES", 0)
    monkeypatch.setattr(gram, "labels", None)  # refused beyond 100,000 samples
    monkeypatch.setattr(gram.Blocks, "rows", None)  # samples x samples on disk
    got = asked(monkeypatch, "t31_kmeans", spark, embeddings=vectors)
    assert {int(r.i): r.cluster for r in got.collect()} == want and len(want) == 120
    own = asked(monkeypatch, "t31_cluster_choice", spark, embeddings=vectors).toPandas()
    assert own[["k", "chosen", "rule"]].equals(choice[["k", "chosen", "rule"]]) and len(own) == 14
    assert np.allclose(own["inertia"], choice["inertia"]) and np.allclose(own["silhouette"], choice["silhouette"])


def test_centres_that_lose_their_rows_stay(spark, vectors):
    from hyphalake.operators import clusters

    rng = np.random.default_rng(2)
    z = rng.normal(size=(30, 5))
    e = clusters._excess(z)
    d = 1 - z @ z.T / 5
    np.fill_diagonal(d, 0)
    members = np.arange(3, 9)
    c = clusters._Centres(z[members].mean(axis=0)[None], (e[members, None] * z[members]).mean(axis=0)[None], np.array([(e[members] ** 2).sum() / 36]), np.array([6.0]), {})
    want = ((d - d[members].mean(axis=0)) ** 2).sum(axis=1)
    g, at = z.T @ z / 25, np.arange(30)
    own = np.full(30, 255)
    own[members] = 0
    assert np.allclose(clusters._vector_gap(z, e, at, own, c, g)[:, 0], want)
    c.held[0] = members
    assert np.allclose(clusters._vector_gap(z, e, at, np.full(30, 255), c, g)[:, 0], want)


def test_too_few_vectors_have_no_clusters(spark, monkeypatch, vectors):
    assert asked(monkeypatch, "t31_kmeans", spark, embeddings=vectors.limit(2)).count() == 0
    assert asked(monkeypatch, "t31_cluster_choice", spark, embeddings=vectors.limit(2)).count() == 0


def _genomes(spark, n):
    region = spark.createDataFrame(list(enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])), "r_regionkey int, r_name string")
    nation = spark.range(25).selectExpr("cast(id as int) as n_nationkey", "concat('n', id) as n_name", "cast(id % 5 as int) as n_regionkey")
    return {"region": region, "nation": nation, "supplier": spark.range(n).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey", "cast(id * 37 % 9000 as double) as s_acctbal")}


def test_rare_features_of_many_genomes_need_no_factor(spark, monkeypatch):
    lines = spark.range(5100).selectExpr("id as l_orderkey", "cast(1 as int) as l_linenumber", "id % 2000 as l_partkey", "id as l_suppkey")
    assert asked(monkeypatch, "t12_mixed_model", spark, lineitem=lines, **_genomes(spark, 5100)).count() == 0  # refused before


def test_relatedness_beyond_5000_is_not_refused(spark):
    from hyphalake.operators import gram

    one = gram.Blocks(list(range(5001)), spark.createDataFrame([], "bi int, bj int, v binary"), "int")
    assert one.matrix().shape == (5001, 5001)


def test_components_without_a_whole_factor(spark, monkeypatch):
    from hyphalake.operators import gram, kinship

    rng = np.random.default_rng(4)
    cells = [(s, p, float(rng.normal())) for p in range(90) for s in rng.permutation(60)[: 4 if p % 2 else 50].tolist()]
    rows = spark.createDataFrame(cells, "sample int, pos int, z double")
    want = kinship.principal_components(gram.of_sites(rows), 3).toPandas()
    z = np.zeros((60, 90))
    for s, p, v in cells:
        z[s, p] = v
    monkeypatch.setattr(kinship, "FACTORED", 10)
    monkeypatch.setattr(gram, "SPARSE", 1)  # products of cells, not of dense strips
    blocks = gram.of_sites(rows, block=16, strip_bytes=1 << 13)
    assert np.allclose(blocks.matrix(), z @ z.T / 90)
    got = kinship.principal_components(blocks, 3).toPandas()
    assert np.allclose(got.iloc[:, 1:], want.iloc[:, 1:], atol=1e-8)
    twice = np.kron(np.eye(2), z @ z.T)
    s, u = kinship.top_eigen(twice, 4)
    assert np.allclose(s, np.linalg.eigvalsh(twice)[::-1][:4]) and np.allclose(twice @ u, u * s, atol=1e-7)


def test_shared_paths_are_made_by_compiled_code(spark, monkeypatch):
    from hyphalake.operators import tree

    edges = tree.tree_table(spark, "((a:1,(b:2,c:1.5):0.5):2,d:4,((e:1):1,f:2.5):1);")
    rows = lambda df: sorted(map(tuple, df.collect()))
    got = tree.shared_path_lengths(edges)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    assert rows(got) == rows(tree._walked_path_lengths(edges, 4)) and len(rows(got)) == 36
    monkeypatch.setattr(tree, "SENT", 0)
    monkeypatch.setattr(tree, "TASK", 2)
    assert rows(tree.shared_path_lengths(edges)) == rows(got)
    monkeypatch.setattr(tree, "LEVELS", 2)
    assert rows(tree.shared_path_lengths(edges)) == rows(got)


def test_relationship_of_vectors_names_no_samples_on_the_driver(spark, monkeypatch, vectors):
    from hyphalake.operators import gram

    want = {(r.i, r.j): r.v for r in gram.of_vectors(vectors, "vec_id", "embedding").pairs().collect()}
    monkeypatch.setattr(gram, "labels", None)  # refused beyond 100,000 samples
    got = gram.vector_pairs(vectors, "vec_id", "embedding", block=7)
    got = {(r.i, r.j): r.v for r in got.collect()}
    assert got.keys() == want.keys() and len(got) == 120 * 120 and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert asked(monkeypatch, "t20_relationship", spark, embeddings=vectors).count() == 120 * 120


def test_sets_far_apart_are_dropped_where_they_meet(spark):
    from hyphalake.operators import relational

    rng = np.random.default_rng(8)
    sets = [sorted(set(rng.integers(0, 90, rng.integers(1, 40)).tolist())) for _ in range(80)]
    sets += [sorted(set(s[: len(s) * 3 // 4]) | {200 + k}) for k, s in enumerate(sets[:40])] + [sets[0], [5], [5]]
    want = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if a < b and 2 * len(set(x) & set(y)) >= len(set(x) | set(y))}
    table = spark.createDataFrame(list(enumerate(sets)), "key long, items array<long>")
    for words in (1, 8):
        assert {(r.a, r.b) for r in relational.similar_sets(table, 0.5, words=words).collect()} == want and len(want) > 30
