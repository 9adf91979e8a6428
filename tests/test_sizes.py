"""Queries on keys, texts and numbers of samples beyond those of the small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hyphalake.plans import base, registry  # noqa: F401


class Given(base.Tables):
    """Tables given by name."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "")
        self.__dict__.update(tables)


def asked(monkeypatch, name, spark, **tables):
    monkeypatch.setattr(base, "Tables", lambda s, folder: Given(s, **tables))
    return registry.QUERIES[name](spark, "")


def test_region_numbers_beyond_three_digits(spark, monkeypatch):
    out = asked(monkeypatch, "f30_region_numbers", spark, supplier=spark.range(7).select(F.expr("pow(10, id)").cast("long").alias("s_suppkey")))
    assert all(r.s_suppkey == r.region for r in out.collect()) and out.count() == 7


def test_rule_classifier_bounds_words_as_its_sql(spark, monkeypatch):
    import duckdb

    texts = [(1, "In inßtzer"), (2, "the theé in inü"), (3, "éthe the"), (4, "the the of"), (5, "xin in"), (6, None), (7, "ofof"), (8, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = asked(monkeypatch, "t1_rule_classifier", spark, documents=docs).collect()
    documents = docs.toPandas()  # noqa: F841
    want = duckdb.connect().sql(registry.ORACLE_SQL["t1_rule_classifier"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_kmeans_sends_the_driver_one_set_of_sums(spark, monkeypatch):
    import numpy as np

    from hyphalake.operators import clusters

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.1, (40, 6)) for c in (0, 3, 9)])
    rows = spark.createDataFrame([(str(k), k, v.tolist()) for k, v in enumerate(x)], "i string, at long, row array<double>").repartition(16, "at")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    sent = []
    for name in ("collect", "toArrow"):
        plain = getattr(type(rows), name)
        monkeypatch.setattr(type(rows), name, lambda self, plain=plain: (lambda out: sent.append(len(out)) or out)(plain(self)))
    try:
        given, inertia = clusters.kmeans(rows, [2, 3, 4], sent=0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(n for n in sent if n != 120) <= 3 * 4  # numbers of clusters x restarts, not tasks
    assert inertia[3] < 40 and len({(r.at // 40, r.cluster) for r in given.where("k = 3").collect()}) == 3


def test_fallback_tests_need_no_matrix_of_genomes(spark, monkeypatch):
    from hyphalake.operators import association, gram

    n = 60
    tables = {"supplier": spark.range(n).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey"), "nation": spark.range(25).selectExpr("cast(id as int) as n_nationkey", "concat('n', id) as n_name", "cast(id % 5 as int) as n_regionkey"), "region": spark.createDataFrame(list(enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])), "r_regionkey int, r_name string")}
    tables["lineitem"] = spark.range(n * 20).selectExpr("id as l_orderkey", "cast(1 as int) as l_linenumber", "xxhash64(id) % 7 as l_partkey", f"id % {n} as l_suppkey")
    tables = {k: v.cache() for k, v in tables.items()}
    want = {r.feature: r for r in asked(monkeypatch, "t13_fallback_tests", spark, **tables).collect()}
    monkeypatch.setattr(gram.Blocks, "matrix", None)  # refused beyond 5000
    monkeypatch.setattr(association, "CELLS", n * 2)
    got = {r.feature: r for r in asked(monkeypatch, "t13_fallback_tests", spark, **tables).collect()}
    assert got.keys() == want.keys() and got
    assert all(abs(got[k].beta - want[k].beta) < 1e-9 and abs(got[k].pvalue - want[k].pvalue) < 1e-9 for k in got)


def test_power_of_many_samples_makes_no_grid(monkeypatch):
    import numpy as np

    from hyphalake.functions import special
    from hyphalake.operators import association

    grid = special.fisher_grid(30, 50)
    table = special.log_factorials(80)
    p = lambda n, q: np.array([np.exp(table[n] - table[k] - table[n - k] + k * np.log(q) + (n - k) * np.log(1 - q)) for k in range(n + 1)])
    likely = np.outer(p(30, 5 * 0.2 / (0.8 + 5 * 0.2)), p(50, 0.2))
    assert abs(association.exact_power(30, 50, 0.2, 5.0) - likely[(likely > 1e-12) & (grid < 0.05)].sum()) < 1e-12
    monkeypatch.setattr(association, "fisher_grid", None)
    assert 0.99 < association.exact_power(3000, 12_000, 0.2, 2.0) <= 1


def test_components_and_linkage_of_vectors_are_those_of_their_matrix(spark, monkeypatch):
    import numpy as np

    from hyphalake.operators import gram, kinship

    rng = np.random.default_rng(11)
    x = rng.normal(size=(60, 7)) * [3, 1, 1, 2, 1, 5, 1]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows[3] = (3, [1.0, None, float("nan"), 2.0])
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    names, m = kinship.matrix(gram.of_vectors(vectors, "vec_id", "embedding"))
    want = {r.sample_id: r[1:] for r in kinship.principal_components(gram.of_vectors(vectors, "vec_id", "embedding"), 5).collect()}
    slow = kinship.average_linkage(m.max() - m)
    monkeypatch.setattr(gram.Blocks, "matrix", None)  # refused beyond 5000
    got = {r.sample_id: r[1:] for r in kinship.vector_components(vectors, "vec_id", "embedding", 5).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-6) for k in got)
    own, z = kinship.vector_matrix(vectors, "vec_id", "embedding")
    fast = kinship.vector_linkage(z)
    assert own == names and [x[:2] for x in fast] == [x[:2] for x in slow] and np.allclose([x[2] for x in fast], [x[2] for x in slow])
    assert asked(monkeypatch, "g8_linkage", spark, embeddings=vectors).count() == 59
    assert sorted(r["sample"] for r in asked(monkeypatch, "o10_leaf_order", spark, embeddings=vectors).collect()) == list(range(60))
    copies = kinship.vector_linkage(np.repeat(z, 3, axis=0))
    assert len(copies) == 179 and len({b for _, b, _ in copies}) == 179


def test_known_cluster_files_grow_in_number(spark, monkeypatch):
    from hyphalake.plans import files

    monkeypatch.setattr(files, "BLOCKS", 5)
    lines = spark.range(400).selectExpr("id as l_orderkey", "cast(1 + id % 7 as int) as l_linenumber", "id as l_partkey", "id % 9 as l_suppkey", "5.0D as l_quantity", "id + 0.5D as l_extendedprice")
    out = asked(monkeypatch, "s19_known_cluster_files", spark, lineitem=lines)
    assert out.count() == lines.where("l_linenumber < 5").count() and len(out.inputFiles()) > 30  # 16 values at most before


def test_rarefaction_meets_orders_in_chunks(spark, monkeypatch):
    import hashlib

    from hyphalake.operators import pangenome

    monkeypatch.setattr(pangenome, "CELLS", 40)  # every task read all orders' names and kept a dense part before
    rows = sorted({(f, (f * 7 + k * k) % 12) for f in range(40) for k in range(f % 9 + 1)} | {(90, g) for g in range(12)})
    got = {(r.perm, r.n): (r.pan, r.core) for r in pangenome.rarefaction(spark.createDataFrame(rows, "og int, genome int"), 5, places=24).collect()}
    own = {}
    for f, g in rows:
        own.setdefault(f, set()).add(g)
    for p in range(5):
        order = sorted(range(12), key=lambda g: hashlib.md5(f"0|{p}|{g}".encode()).hexdigest())
        for n in range(1, 13):
            seen = set(order[:n])
            assert got[p, n] == (sum(bool(x & seen) for x in own.values()), sum(seen <= x for x in own.values()))
    assert len(got) == 60


def _lines(spark, n=400):
    out = {"lineitem": spark.range(n).selectExpr("id % 97 as l_orderkey", "cast(1 + id % 7 as int) as l_linenumber", "id % 83 as l_partkey", "id % 9 as l_suppkey", "5.0D as l_quantity", "id + 0.5D as l_extendedprice", "0.01D * (id % 10) as l_discount", "0.01D * (id % 8) as l_tax")}
    out["orders"] = spark.range(90).selectExpr("id as o_orderkey", "id % 11 as o_custkey")
    out["supplier"] = spark.range(9).selectExpr("id as s_suppkey", "cast(id as int) as s_nationkey")
    out["nation"] = spark.range(9).selectExpr("cast(id as int) as n_nationkey", "'n' as n_name", "cast(id % 3 as int) as n_regionkey")
    out["region"] = spark.createDataFrame([(0, "ASIA"), (1, "EUROPE"), (2, "AFRICA")], "r_regionkey int, r_name string")
    return out


def test_tasks_grow_in_number_with_rows(spark, monkeypatch):
    from hyphalake.operators import relational

    tables = _lines(spark)
    want = {q: sorted(map(tuple, asked(monkeypatch, q, spark, **tables).collect())) for q in ("x3_gene_checks", "a28_genus_classes", "t24_best_per_combined", "a27_core_compartments")}
    monkeypatch.setattr(relational, "ROWS", 10)
    for q, rows in want.items():
        assert sorted(map(tuple, asked(monkeypatch, q, spark, **tables).collect())) == rows and rows
    assert asked(monkeypatch, "x3_gene_checks", spark, **tables).rdd.getNumPartitions() == 40  # as many as the session says before
    assert asked(monkeypatch, "a28_genus_classes", spark, **tables).rdd.getNumPartitions() == 40


def test_classifier_is_dealt_whatever_the_files(spark, monkeypatch):
    customers = spark.range(45_000).selectExpr("id as c_custkey", "concat('Customer#', id) as c_name").coalesce(1)
    assert asked(monkeypatch, "t1_isolate_classifier", spark, customer=customers).rdd.getNumPartitions() == 3


def test_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    from hyphalake.sources import readers

    for k in range(3):
        (tmp_path / f"{k}.tsv").write_text(f"\nz\tcolumn {k % 2}\n" + "a\tb\n" * 50)
    monkeypatch.setattr(readers.F, "min_by", None)
    found = readers._by_header(spark, str(tmp_path))
    assert {h: len(p) for h, p in found.items()} == {"z\tcolumn 0": 2, "z\tcolumn 1": 1}


def test_wide_export_is_no_expression_a_column(spark, monkeypatch):
    n = 12_000  # a pivot takes at most 10,000 values unless they are given, and an expression for each
    lines = spark.range(3 * n).selectExpr("id % 5 as l_partkey", f"id % {n} as l_suppkey")
    part = spark.range(5).selectExpr("id as p_partkey", "concat('b', id % 2) as p_brand")
    out = asked(monkeypatch, "k4_wide_export_whole", spark, lineitem=lines, part=part, supplier=spark.range(n).selectExpr("id as s_suppkey"))
    assert len(out.columns) == n + 1
    assert "MapInArrow" in out._jdf.queryExecution().analyzed().getClass().getSimpleName()
    want = {(r.b, r.g) for r in lines.join(part, lines.l_partkey == part.p_partkey).selectExpr("p_brand as b", "l_suppkey as g").distinct().collect()}
    got = {r[0]: r[1:] for r in out.collect()}
    assert {(b, g) for b, row in got.items() for g in range(n) if row[g] == 1} == want


def test_wide_files_need_no_column_a_genome_in_a_plan(spark, monkeypatch):
    """Orthogroups and gene counts of 1,030 genomes, in files of few columns each, beside their SQL twins."""
    import duckdb

    region = spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    nation = spark.createDataFrame([(0, "x", 0), (1, "y", 1)], "n_nationkey int, n_name string, n_regionkey int")
    supplier = spark.range(1030).select(F.col("id").alias("s_suppkey"), (F.col("id") % 2).cast("int").alias("s_nationkey"))
    lineitem = spark.range(3000).select((F.col("id") % 700).alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"), F.when(F.col("id") > 5, F.col("id") % 7).alias("l_partkey"), (F.col("id") * 37 % 1030).alias("l_suppkey"))
    given = {"region": region, "nation": nation, "supplier": supplier, "lineitem": lineitem}
    monkeypatch.setattr(type(lineitem.groupBy()), "pivot", lambda *a: (_ for _ in ()).throw(AssertionError("a column a genome")))
    c = duckdb.connect()
    for name, df in given.items():
        c.register(name, df.toPandas().convert_dtypes())
    for name in ("s13_orthogroup_files", "s14_gene_count_files"):
        got = asked(monkeypatch, name, spark, **given)
        rel = c.sql(registry.ORACLE_SQL[name])
        assert sorted(map(str, map(tuple, got.select(rel.columns).collect()))) == sorted(map(str, rel.fetchall())), name


def test_wide_cells_in_quotes(spark, tmp_path):
    from hyphalake.sources import readers

    (tmp_path / "q.tsv").write_text('Orthogroup\t"GCA_000000001.1_a"\tGCA_000000002.1_b\nN0\t"p\\"1\tx"\t\n\nN1\t""\tp2, p3\n')
    got = readers.orthogroups(spark, str(tmp_path / "q.tsv"))
    assert sorted(map(tuple, got.collect())) == [("N0", "GCA_000000001.1", 'p"1\tx'), ("N1", "GCA_000000002.1", "p2"), ("N1", "GCA_000000002.1", "p3")]
