"""Functions and statistics against values worked out by hand and closed forms."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hyphalake.functions import rules, special, terms, text
from hyphalake.operators import association, burden, gram, kinship, pangenome, tree


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_cells(spark):
    r = one(
        spark,
        split=text.split_terms(F.lit(" a; b ,c| ;-x")),
        none=text.split_terms(F.lit("-")),
        joined=text.unique_join(F.array(F.lit("b"), F.lit("a"), F.lit("b"), F.lit("-"), F.lit(""))),
        both=text.combine_annotations(F.lit("a,b"), F.lit(None).cast("string"), F.lit("b;c")),
        cazy=text.cazy_families(F.lit("GH5(1-200)+CBM1"), F.lit("GH5_2 XX9")),
        ec=text.ec_numbers(F.lit("EC:1.2.3.4,5.6.7.8 9.9.9")),
        acc=text.accession(F.lit("x_GCF_000002855.4_ASM")),
        loose=text.unversioned(F.lit("GCF_000002855.4_ASM285v2")),
        exact=text.unversioned_exact(F.lit("GCF_000002855.4_ASM285v2")),
        bare=text.unversioned_exact(F.lit("GCF_000002855.4")),
        contrast=text.contrast_name(F.lit("Human-pathogenic")),
        species=text.species_label(F.lit("flavus_ani_filtered__GCF_1.1")),
        region=text.region_number(F.lit("x.region007")),
        aliases=text.gene_aliases(F.lit("FUN_1-T1")),
        master=text.wgs_master(F.lit("ABCD01000012")),
        title=text.genbank_field(F.lit("LOCUS x\nDEFINITION  a long\n            title.\nACCESSION y")),
    )
    assert r.split == ["a", "b", "c", "-x"] and r.none == [] and r.joined == "b, a" and r.both == "a, b, c"
    assert r.cazy == ["GH5", "CBM1", "GH5_2"] and r.ec == ["1.2.3.4", "5.6.7.8"] and r.acc == "GCF_000002855.4"
    assert r.loose == "GCF_000002855" and r.exact == "GCF_000002855.4_ASM285v2" and r.bare == "GCF_000002855"
    assert r.contrast == "human_pathogenic_vs_rest" and r.species == "flavus" and r.region == 7
    assert r.aliases == ["FUN_1-T1", "FUN_1", "ncbi_FUN_1"] and r.master == "ABCD01000000" and r.title == "a long title."


@pytest.mark.parametrize("cell, at", [("35.7 N 139.7 E", (35.7, 139.7)), ("10.5 S 20.1 W", (-10.5, -20.1)), ("missing", None), ("1.5, -2", (1.5, -2.0)), ("a b", None), ("1 N 2", None)])
def test_coordinates(spark, cell, at):
    r = one(spark, p=text.parse_lat_lon(F.lit(cell))).p
    assert (None if r is None else (r.lat, r.lon)) == at


def test_sequences_and_scores(spark):
    r = one(spark, gc=text.gc_percent(F.lit("GCat")), flags=text.cds_flags(F.lit("atgaaatga")), score=text.quality_score(F.lit(100.0 * 3600 / 3800), F.lit(100), F.lit(1_000_000)), share=text.quality_score(F.lit(0.95), F.lit(0), F.lit(0)))
    assert r.gc == 50.0 and r.flags.starts and r.flags.stops and r.flags.in_frame
    assert r.score == pytest.approx(94.7368, abs=1e-4) and r.share == 95.0


def test_informative_terms(spark):
    t = lambda layer, term, d=None: terms.is_informative(F.lit(layer), F.lit(term), F.lit(d).cast("string"))
    r = one(spark, a=t("COG_category", "s"), b=t("COG_category", "K"), c=t("PFAMs", "DUF1"), d=t("KEGG_ko", "K1", "Hypothetical protein X"), e=t("GOs", "GO:0008150"), f=t("EC", "-.-.-.-"), g=t("CAZy", "GH5"), h=t("CAZy", None), i=t("CAZy", "nan"))
    assert list(r) == [False, True, False, False, False, False, True, False, False]


CASES = [
    ({"Isolation Source": "soil"}, "Environmental", "Environmental"),
    ({"Isolation Source": "sputum of a patient"}, "Clinical", "Human-pathogenic"),
    ({"Isolation Source": "human feces on agar"}, "Clinical", "Environmental"),
    ({"Isolation Source": "unknown"}, "Unknown", "Unknown"),
    ({"Isolation Source": "soil", "title": "antifungal azole resistance"}, "Environmental", "Environmental"),
    ({"Isolation Source": "daqu liquor starter", "title": "ochratoxin survey"}, "Industrial-origin", "Industrial-trait"),
    ({"Isolation Source": "maize", "Strain": "NRRL 3357"}, "Culture-derived", "Plant-pathogenic"),
    ({"Strain": "Af293"}, "Unknown", "Human-pathogenic"),
    ({"Isolation Source": "soil", "Assembly Submitter": "FDA"}, "Environmental", "Human-pathogenic"),
    ({"title": "a non-aflatoxigenic aflatoxin strain"}, "Unknown", "Industrial-trait"),
    ({"Isolation Source": "laboratory", "BioProject Description": "sponge"}, "Culture-derived", "Environmental"),
    ({"Isolation Source": "fermented food"}, "Industrial-origin", "Industrial-trait"),
]


def test_isolate_classifier(spark):
    names = sorted({k for c, _, _ in CASES for k in c})
    rows = [(i, *[c.get(n) for n in names]) for i, (c, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"`{n}` string" for n in names))
    got = {r.id: (r.Provenance, r.Phenotype) for r in rules.classify_isolates(df).collect()}
    assert got == {i: (p, f) for i, (_, p, f) in enumerate(CASES)}


def test_kingdoms(spark):
    r = one(spark, a=rules.kingdom(F.lit("Aspergillus virus")), b=rules.kingdom(F.lit("Fusarium")), c=rules.kingdom(F.lit("E. coli bacterium")), d=rules.kingdom(F.lit(None).cast("string")))
    assert list(r) == ["Aspergillus (self)", "Other fungi", "Bacteria", "Unknown"]


@pytest.mark.parametrize("cells, side, p", [((3, 1, 1, 3), "two-sided", 0.485714), ((3, 1, 1, 3), "greater", 0.242857), ((8, 2, 1, 5), "two-sided", 0.034965), ((10, 0, 0, 10), "two-sided", 1.0825e-05), ((0, 0, 3, 4), "two-sided", 1.0)])
def test_fisher(cells, side, p):
    assert special.fisher_exact(*cells, side) == pytest.approx(p, rel=1e-4)


def test_special_functions(spark):
    assert special.chi2_sf(11.983, 4) == pytest.approx(0.01748, abs=1e-4) and special.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert special.chi2_sf(7.814728, 3) == pytest.approx(0.05, abs=1e-6) and special.chi2_quantile_1(0.05) == pytest.approx(3.841459, abs=1e-5)
    assert special.t_sf2(2.228139, 10) == pytest.approx(0.05, abs=1e-6) and special.beta_inc(2, 3, 0.5) == pytest.approx(0.6875)
    assert special.binomial_test(8, 10) == pytest.approx(0.109375) and special.clopper_pearson(8, 10) == pytest.approx((0.4439, 0.9748), abs=1e-4)
    u, p = special.mann_whitney_greater(np.array([3.0, 4, 5]), np.array([1.0, 2, 2]))
    assert u == 9 and p < 0.05
    assert one(spark, s=special.chi2_even_sf(F.lit(11.983), F.lit(2))).s == pytest.approx(0.01748, abs=1e-4)


def test_class_thresholds():
    u_shaped = [500, 200, 100, 60, 40, 30, 25, 20, 18, 17, 18, 20, 25, 30, 40, 60, 100, 300, 900, 4000]
    core, rare = pangenome.class_thresholds(u_shaped)
    assert 16 <= core <= 20 and 1 <= rare <= 4
    assert pangenome.class_thresholds([0] * 20)[0] <= 20


def test_mixed_model_equals_least_squares_without_kinship():
    rng = np.random.default_rng(1)
    n = 80
    y, g = rng.integers(0, 2, n).astype(float), rng.integers(0, 2, (n, 5)).astype(float)
    beta, se, p = association.NullModel(y, np.ones((n, 1)), np.eye(n)).test(g)
    for j in range(5):
        x = np.column_stack((np.ones(n), g[:, j]))
        b = np.linalg.lstsq(x, y, rcond=None)[0]
        r = y - x @ b
        assert beta[j] == pytest.approx(b[1]) and se[j] == pytest.approx(math.sqrt(r @ r / (n - 2) * np.linalg.inv(x.T @ x)[1, 1]))


def test_mixed_model_finds_heritability():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(120, 400))
    k = z @ z.T / 400
    y = np.linalg.cholesky(k + 1e-6 * np.eye(120)) @ rng.normal(size=120) * 2 + rng.normal(size=120) * 0.5
    assert association.NullModel(y, np.ones((120, 1)), k).h2 > 0.7
    assert association.NullModel(rng.normal(size=120), np.ones((120, 1)), k).h2 < 0.5


def test_burden_fit_equals_least_squares():
    rng = np.random.default_rng(3)
    x = np.column_stack((np.ones(50), rng.integers(0, 2, 50)))
    y = x @ [1.0, 0.5] + rng.normal(size=50) * 0.1
    r = burden.fit_burden(y, x)
    assert r["beta"] == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0][1]) and r["pvalue"] < 1e-6 and r["fold"] == pytest.approx(math.exp(r["beta"]))
    assert burden.fit_burden(y, x, np.eye(50))["beta"] == pytest.approx(r["beta"])


def test_power_grows_with_odds():
    assert association.exact_power(20, 20, 0.2, 1.0) < 0.05 < association.exact_power(20, 20, 0.2, 5.0) < association.exact_power(20, 20, 0.2, 20.0)
    assert association.least_detectable_odds(3, 3, 0.1) == math.inf


NEWICK = "((A:1,B:1):1,(C:1,D:1):1);"


@pytest.mark.parametrize("states, changes", [("1100", 1), ("1010", 2), ("1111", 0), ("1000", 1)])
def test_parsimony(spark, states, changes):
    edges = tree.tree_table(spark, NEWICK)
    rows = spark.createDataFrame([("t", x, int(s)) for x, s in zip("ABCD", states)], "og string, tip string, state int")
    traits = rows.select("og").distinct()
    assert tree.parsimony(edges, traits, rows, default=None).first().changes == changes == tree.fitch_changes(tree.parse_newick(NEWICK), dict(zip("ABCD", map(int, states))))
    e = tree.gains_and_losses(edges, traits, rows).first()
    assert e.gains + e.losses == changes
    present = rows.where("state = 1")  # the other tips have the default state
    assert tree.parsimony(edges, traits, present).first().changes == changes


def test_parsimony_on_a_deep_tree(spark):
    """A chain of depth 60 and many traits, each against the count of one trait at a time."""
    import random

    newick = "".join("(" for _ in range(60)) + "t0" + "".join(f",t{k}):1" for k in range(1, 61)) + ";"
    nodes, rng = tree.parse_newick(newick), random.Random(8)
    states = {f"og{i}": {f"t{k}": int(rng.random() < 0.3) for k in range(61) if rng.random() < 0.8} for i in range(300)}
    states["none"] = {}
    rows = spark.createDataFrame([(o, t, s) for o, own in states.items() for t, s in own.items()], "og string, tip string, state int")
    traits = spark.createDataFrame([(o,) for o in states], "og string")
    edges = tree.tree_table(spark, newick)
    got = {r.og: r.changes for r in tree.parsimony(edges, traits, rows, default=None).collect()}
    assert got == {o: tree.fitch_changes(nodes, own) for o, own in states.items()}
    full = {r.og: r.changes for r in tree.parsimony(edges, traits, rows).collect()}
    assert full == {o: tree.fitch_changes(nodes, {f"t{k}": own.get(f"t{k}", 0) for k in range(61)}) for o, own in states.items()}
    sets = tree.downpass(edges, traits, rows, default=None)
    assert sets.where("og = 'none'").count() == 0 and sets.columns == ["og", "node", "depth", "parent", "mask", "changes"]
    assert sets.where("parent is null").count() == 300


def test_tree_paths(spark):
    shared = {(r.i, r.j): r.v for r in tree.shared_path_lengths(tree.tree_table(spark, NEWICK)).collect()}
    assert shared["A", "A"] == 2 and shared["A", "B"] == 1 and shared["A", "C"] == 0
    paths = {(r.tip, r.node): (r.depth, r.cum) for r in tree.tip_paths(tree.tree_table(spark, NEWICK)).collect()}
    assert len(paths) == 12 and {v for (t, _), v in paths.items() if t == "C"} == {(0, 0.0), (1, 1.0), (2, 2.0)}
    deep = tree.parse_newick("".join("(" for _ in range(60)) + "t0:1" + "".join(f",t{k}:{k}):2" for k in range(1, 61)) + ";")
    edges = spark.createDataFrame(deep, tree.EDGES)
    held: dict = {}
    for r in tree.tip_paths(edges).collect():
        held.setdefault(r.tip, {})[r.node] = r.cum
    for r in tree.shared_path_lengths(edges).collect():
        assert r.v == max(held[r.i][n] for n in held[r.i].keys() & held[r.j].keys())
    assert len(held) == 61
    named = tree.parse_newick("('a b':1.5,(c,d)x:2e-1[note])r;")
    assert [n[4] for n in named if n[4]] == ["a b", "c", "d"]


def test_similarity(spark):
    assert kinship.elbow([2, 3, 4, 5], [100, 40, 35, 33]) == 3
    assert kinship.choose_k([2, 3, 4, 5], [100, 40, 35, 33], [0.3, 0.6, 0.2, 0.1], 50) == (3, "agree")
    assert kinship.choose_k([2, 3, 4, 5], [100, 40, 35, 33], [0.3, 0.32, 0.35, 0.3], 50)[1] == "flat silhouette"
    df = spark.createDataFrame([(1, "abcdefghij" * 9), (2, "abcdefghij" * 9), (3, "z" * 90)], "k int, t string")
    got = [(r.a, r.b, r.distance) for r in kinship.mash_pairs(kinship.kmer_sketch(df, "k", "t", 5, 50), "k", 5).collect()]
    assert got == [(1, 2, 0.0)]


def test_grm_matches_numpy(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(6, 9))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(6)], "s int, v array<double>")
    names, k = kinship.matrix(gram.of_vectors(df, "s", "v"))
    z = (m - m.mean(axis=0)) / (m.std(axis=0) + 1e-10)
    assert names == list(range(6)) and np.allclose(k, z @ z.T / 9)
    pcs = kinship.principal_components(gram.of_vectors(df, "s", "v"), 3).toPandas()
    assert pcs.shape == (6, 4)


def test_matrix_helpers(spark):
    coded = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 1.0), ("c", 0, None), ("d", 0, 2.0)], "sample string, pos int, code double")
    assert {r["sample"]: r.code for r in kinship.impute_mode(coded).collect()}["c"] == 1.0
    blocks = spark.createDataFrame([("x", 1, 1, 2.0), ("x", 1, 2, 1.0), ("x", 2, 2, 4.0)], "species string, i int, j int, v double")
    assert {(r.i, r.j): r.v for r in burden.block_covariance(blocks).collect()} == {(1, 1): 2 / 3, (1, 2): 1 / 3, (2, 2): 4 / 3}
    d = spark.createDataFrame([(i, j, 0.0 if i == j else 1.0 if i // 2 == j // 2 else 10.0) for i in range(4) for j in range(4)], "i int, j int, v double")
    c = spark.createDataFrame([(i, i // 2) for i in range(4)], "i int, cluster int")
    assert kinship.silhouette(d, c).first().silhouette == pytest.approx(0.9)
    assert kinship.leaf_order(list("abcd"), np.array([[0, 9, 1, 9], [9, 0, 9, 1], [1, 9, 0, 9], [9, 1, 9, 0.0]])) in (["a", "c", "b", "d"], ["b", "d", "a", "c"])


def test_conservation_counts(spark):
    from hyphalake.operators import isolates

    df = spark.createDataFrame([("a", "Core", "Absent"), ("b", "Core", "Core"), ("c", None, "Rare")], "gene string, class_x string, class_y string")
    assert {r.gene: (r.n_core, r.n_present) for r in isolates.conservation(df, ["x", "y"]).collect()} == {"a": (1, 1), "b": (2, 2), "c": (0, 1)}


def test_clumping_deals_shuffles_and_draws_in_slices(spark, monkeypatch):
    """Blocks of shuffles are not joined to one task, and slices of draws give the same shuffles as whole blocks."""
    edges = tree.tree_table(spark, "((((A:1,B:1):1,C:1):1,(D:1,(E:1,F:1):1):1):1,(G:1,H:1,I:1):1,J:1);")
    rows = spark.createDataFrame([(f"og{k}", t, 1) for k in range(1, 10) for t in "ABCDEFGHIJ"[:k]], "og string, tip string, state int")
    traits = rows.select("og").distinct()
    whole = sorted(tree.clumping(edges, traits, rows).collect())
    monkeypatch.setattr(tree, "DRAWN", 30)
    monkeypatch.setattr(tree, "BLOCKS", 1)
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    before = stages().size()
    assert sorted(tree.clumping(edges, traits, rows).collect()) == whole
    now = stages()
    assert max(now.apply(k).numTasks() for k in range(now.size() - before)) == 9 * 4


def test_clumping(spark):
    """Observed changes and every shuffle against a walk of one trait at a time, and the null against all shuffles."""
    import random
    from itertools import combinations

    newick = "((((A:1,B:1):1,C:1):1,(D:1,(E:1,F:1):1):1):1,(G:1,H:1,I:1):1,J:1);"
    nodes, tips, rng = tree.parse_newick(newick), "ABCDEFGHIJ", random.Random(4)
    edges = tree.tree_table(spark, newick)
    walk = tree.Walk(edges)
    has = np.array([[rng.random() < 0.4 for _ in range(77)] for _ in tips])
    own = [{t: int(has[list(walk.tips).index(t), k]) for t in tips} for k in range(77)]
    assert walk.changes(has).tolist() == [tree.fitch_changes(nodes, s) for s in own]
    states = {f"og{k}": s for k, s in enumerate(own[:20])} | {"all": dict.fromkeys(tips, 1), "none": {}, "clumped": dict.fromkeys("DEF", 1)}
    rows = spark.createDataFrame([(o, t, s) for o, x in states.items() for t, s in x.items()] + [("og0", "elsewhere", 1)], "og string, tip string, state int")
    got = {r.og: r for r in tree.clumping(edges, spark.createDataFrame([(o,) for o in states], "og string"), rows, n_perm=3000).collect()}
    assert set(got) == set(states)
    for o, s in states.items():
        r, n1 = got[o], sum(s.values())
        full = {t: s.get(t, 0) for t in tips}
        assert (r.observed, r.n_present) == (tree.fitch_changes(nodes, full), n1)
        if n1 in (0, 10):
            assert (r.D, r.p_random, r.p_brownian, r.random_mean) == (None,) * 4
            continue
        every = [tree.fitch_changes(nodes, {t: int(t in c) for t in tips}) for c in combinations(tips, n1)]
        mean = sum(every) / len(every)
        assert r.random_mean == pytest.approx(mean, abs=0.08) and r.clumped == pytest.approx(n1 * (10 - n1) / 20)
        assert r.p_random == pytest.approx(sum(x <= r.observed for x in every) / len(every), abs=0.04)
        assert r.p_brownian == pytest.approx(sum(x >= r.observed for x in every) / len(every), abs=0.04)
        assert r.D == pytest.approx((r.observed - r.clumped) / (r.random_mean - r.clumped) if abs(r.random_mean - r.clumped) > 1e-10 else 0)
