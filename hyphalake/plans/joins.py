"""Equi, semi, anti, range and self joins of the analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.functions.text import gene_aliases
from hyphalake.operators import association, convergence, isolates, relational
from hyphalake.plans.base import Tables, query, rounded
from hyphalake.sources.readers import annotated_members


@query("j1_annotated_members", "SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, c_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey")
def j1(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("accession"), "l_linenumber", "l_partkey")
    first = t.orders.select(F.col("o_orderkey").alias("accession"), "o_orderstatus")
    second = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("accession"), "c_name")
    return annotated_members(rows, [first, second], ["accession"]).withColumnRenamed("accession", "l_orderkey")


@query("j3_annotated_results", "SELECT s_suppkey AS feature, s_acctbal AS beta, n_name AS annotation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 12")
def j3(t: Tables) -> DataFrame:
    ann = t.nation.where("n_nationkey < 12").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("annotation"))
    return t.supplier.join(F.broadcast(ann), "s_nationkey", "left").select(F.col("s_suppkey").alias("feature"), F.col("s_acctbal").alias("beta"), "annotation")


@query("j4_common_samples", "SELECT regexp_extract(s_name, '#0*([0-9]+)', 1) AS norm_id, s_name, c_name FROM supplier JOIN customer ON regexp_extract(s_name, '#0*([0-9]+)', 1) = regexp_extract(c_name, '#0*([0-9]+)', 1)")
def j4(t: Tables) -> DataFrame:
    norm = lambda c: F.regexp_extract(c, "#0*([0-9]+)", 1).alias("norm_id")
    return t.supplier.select(norm("s_name"), "s_name").join(t.customer.select(norm("c_name"), "c_name"), "norm_id")


@query("j6_feature_map", "SELECT DISTINCT l_partkey AS og, o_custkey AS combined_og FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j6(t: Tables) -> DataFrame:
    return links(t)


def links(t: Tables) -> DataFrame:
    n = t.lineitem.count()
    left = relational.dealt(t.lineitem.select(F.col("l_orderkey").alias("member"), F.col("l_partkey").alias("og")), n, "member")
    right = relational.dealt(t.orders.select(F.col("o_orderkey").alias("member"), F.col("o_custkey").alias("combined_og")), n, "member")
    return convergence.shared_member_map(left, right, ["member"], n=n)


@query("a23_map_accounting", """WITH l AS (SELECT DISTINCT l_partkey AS og, o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey), a AS (SELECT og, count(*) AS n FROM l GROUP BY og), b AS (SELECT c, count(*) AS n FROM l GROUP BY c)
SELECT (SELECT count(*) FROM l) AS n_links, (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, (SELECT sum(greatest(n - 1, 0))::BIGINT FROM a) AS split_extra, (SELECT sum(greatest(n - 1, 0))::BIGINT FROM b) AS merge_extra""")
def a23(t: Tables) -> DataFrame:
    return convergence.map_accounting(links(t))


def results(t: Tables) -> DataFrame:
    """Stand-in results: one row a part and region, effect by price, p by tax."""
    rows = t.lineitem.join(t.genomes(), F.col("l_suppkey") == F.col("genome")).select("species", F.col("l_partkey").alias("og"), "l_discount", "l_tax")
    return relational.dealt(rows, t.lineitem.count(), "og").groupBy("species", "og").agg((F.round(F.avg("l_discount"), 9) - 0.05).alias("beta"), F.round(F.avg("l_tax") / 0.08 + 0.001, 9).alias("pvalue"))


RESULTS = "WITH res AS (SELECT r_name AS species, l_partkey AS og, round(avg(l_discount), 9) - 0.05 AS beta, round(avg(l_tax) / 0.08 + 0.001, 9) AS pvalue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, l_partkey)"


@query("j7_transferred_results", f"{RESULTS}, l AS (SELECT DISTINCT l_partkey AS og, o_custkey AS combined_og FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT species, og, combined_og, round(beta, 9) AS beta, pvalue FROM res JOIN l USING (og) WHERE pvalue < 0.1")
def j7(t: Tables) -> DataFrame:
    return rounded(convergence.transfer(results(t).where("pvalue < 0.1"), links(t)).select("species", "og", "combined_og", "beta", "pvalue"), "beta", digits=9)


@query("a24_merge_best", f"{RESULTS} SELECT og, round(arg_min(beta, (pvalue, beta)), 9) AS beta, min(pvalue) AS pvalue FROM res GROUP BY og")
def a24_best(t: Tables) -> DataFrame:
    return rounded(convergence.merge_results(results(t), ["og"], "best"), "beta", digits=9)


@query("a24_merge_median", f"{RESULTS} SELECT og, round(median(beta), 9) AS beta, min(pvalue) AS pvalue FROM res GROUP BY og")
def a24_median(t: Tables) -> DataFrame:
    return rounded(convergence.merge_results(results(t), ["og"], "median"), "beta", digits=9)


@query("a24_merge_single", f"{RESULTS} SELECT og, round(any_value(beta), 9) AS beta, any_value(pvalue) AS pvalue FROM res WHERE pvalue < 0.3 GROUP BY og HAVING count(*) = 1")
def a24_single(t: Tables) -> DataFrame:
    return rounded(convergence.merge_results(results(t).where("pvalue < 0.3"), ["og"], "single"), "beta", digits=9)


@query("j8_convergent_pairs", f"""{RESULTS}
SELECT x.og, x.species AS group_a, y.species AS group_b, round(x.beta, 9) AS beta_a, round(y.beta, 9) AS beta_b, CASE WHEN sign(x.beta) = sign(y.beta) AND x.beta > 0 THEN 'enriched' WHEN sign(x.beta) = sign(y.beta) THEN 'depleted' ELSE 'opposite' END AS direction
FROM res x JOIN res y ON x.og = y.og AND x.species < y.species WHERE x.pvalue < 0.3 AND y.pvalue < 0.3""")
def j8(t: Tables) -> DataFrame:
    return rounded(convergence.convergent_pairs(results(t).withColumn("qvalue", F.col("pvalue")), q=0.3), "beta_a", "beta_b", digits=9)


@query("t22_convergent_hits", f"""{RESULTS}, s AS (SELECT og, count(DISTINCT species) FILTER (pvalue < 0.25 AND beta > 0) AS sig_up, count(DISTINCT species) FILTER (pvalue < 0.25 AND beta < 0) AS sig_down, count(DISTINCT species) FILTER (pvalue < 0.4 AND beta > 0) AS mod_up, count(DISTINCT species) FILTER (pvalue < 0.4 AND beta < 0) AS mod_down FROM res GROUP BY og)
SELECT *, CASE WHEN sig_up >= 2 OR sig_down >= 2 THEN 'significant' ELSE 'consistent' END AS support, CASE WHEN sig_up >= 2 THEN 'enriched' WHEN sig_down >= 2 THEN 'depleted' WHEN mod_up >= 3 THEN 'enriched' ELSE 'depleted' END AS direction FROM s WHERE sig_up >= 2 OR sig_down >= 2 OR mod_up >= 3 OR mod_down >= 3""")
def t22(t: Tables) -> DataFrame:
    return convergence.convergent_hits(results(t).withColumn("qvalue", F.col("pvalue")), q=0.25, moderate_p=0.4)


@query("j10_feature_comparison", f"""{RESULTS}, x AS (SELECT og AS feature, beta AS beta_a, pvalue < 0.2 AS sig_a FROM res WHERE species = 'ASIA'), y AS (SELECT og AS feature, beta AS beta_b, pvalue < 0.2 AS sig_b FROM res WHERE species = 'EUROPE')
SELECT feature, round(beta_a, 9) AS beta_a, sig_a, round(beta_b, 9) AS beta_b, sig_b, CASE WHEN sig_a AND sig_b AND sign(beta_a) = sign(beta_b) THEN 'shared' WHEN sig_a AND sig_b THEN 'opposite' WHEN sig_a THEN 'first only' WHEN sig_b THEN 'second only' ELSE 'neither' END AS category FROM x JOIN y USING (feature)""")
def j10(t: Tables) -> DataFrame:
    rows = results(t).withColumn("qvalue", F.col("pvalue")).withColumnRenamed("og", "feature")
    return rounded(convergence.compare_features(rows, "ASIA", "EUROPE", q=0.2), "beta_a", "beta_b", digits=9)


@query("j11_interval_overlap", """
WITH a AS (SELECT o_custkey AS k, o_orderkey AS area, datediff('day', DATE '1990-01-01', o_orderdate::DATE)::BIGINT AS s FROM orders), c AS (SELECT o_custkey AS k, l_orderkey AS gene, l_linenumber AS line, datediff('day', DATE '1990-01-01', l_shipdate::DATE)::BIGINT AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT a.k, area, gene, line FROM a JOIN c ON a.k = c.k WHERE a.s <= c.s + 5 AND a.s + 30 >= c.s""")
def j11(t: Tables) -> DataFrame:
    day = lambda c: F.datediff(c, F.lit("1990-01-01").cast("date")).cast("long")
    areas = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("area"), day("o_orderdate").alias("start")).withColumn("end", F.col("start") + 30)
    genes = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("k"), F.col("l_orderkey").alias("gene"), F.col("l_linenumber").alias("line"), day("l_shipdate").alias("start")).withColumn("end", F.col("start") + 5)
    return relational.interval_overlap(areas, genes, ["k"], bin_size=64).select("k", "area", F.col("gene_r").alias("gene"), F.col("line_r").alias("line"))


@query("j12_alias_lookup", "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON replace(s_name, 'Supplier', 'Customer') = c_name")
def j12(t: Tables) -> DataFrame:
    names = t.supplier.select("s_suppkey", F.explode(gene_aliases(F.regexp_replace("s_name", "Supplier", "Customer"))).alias("c_name"))
    return names.join(t.customer, "c_name").select("s_suppkey", "c_custkey").distinct()


@query("j13_confidence_modes", "SELECT c_custkey, c_mktsegment, mode FROM (SELECT *, CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'medium' ELSE 'low' END AS conf FROM customer), (VALUES ('strict'), ('broad'), ('lenient')) m(mode) WHERE mode = 'lenient' OR conf = 'high' OR (mode = 'broad' AND conf = 'medium')")
def j13(t: Tables) -> DataFrame:
    sure = F.when(F.col("c_acctbal") > 5000, "high").when(F.col("c_acctbal") > 0, "medium").otherwise("low")
    return association.confidence_modes(t.customer.withColumn("confidence", sure)).select("c_custkey", "c_mktsegment", "mode")


@query("j14_symmetric_matrix", """WITH d AS (SELECT l_suppkey % 10 AS i, l_linenumber AS j, avg(l_discount) AS v FROM lineitem WHERE l_suppkey % 10 <> l_linenumber GROUP BY 1, 2)
SELECT coalesce(x.i, y.j)::BIGINT AS i, coalesce(x.j, y.i)::BIGINT AS j, round((coalesce(x.v, 0) + coalesce(y.v, 0)) / 2, 9) AS v FROM d x FULL JOIN d y ON x.i = y.j AND x.j = y.i""")
def j14(t: Tables) -> DataFrame:
    rows = t.lineitem.select((F.col("l_suppkey") % 10).alias("a"), F.col("l_linenumber").cast("long").alias("b"), "l_discount")
    return rounded(relational.symmetric(rows, "a", "b", "l_discount"), "v", digits=9)


@query("j15_shared_between_families", """WITH m AS (SELECT DISTINCT n_regionkey AS species, s_nationkey AS family, l_partkey AS og FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT x.family AS family_a, y.family AS family_b, count(*) AS n_shared FROM m x JOIN m y ON x.og = y.og AND x.species < y.species GROUP BY 1, 2""")
def j15(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return convergence.shared_between_families(rows.select(F.col("n_regionkey").alias("species"), F.col("s_nationkey").alias("family"), F.col("l_partkey").alias("og")))


@query("j22_validated_panel", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)")
def j22(t: Tables) -> DataFrame:
    anchored = t.customer.withColumn("gene", F.col("c_custkey").cast("string")).withColumn("species", F.lit("x"))
    keys = lambda df: df.select(F.col("o_custkey").cast("string").alias("gene"), F.lit("X").alias("species"))
    return isolates.validated_panel(anchored, keys(t.orders.where("o_orderstatus = 'F'")), keys(t.orders.where("o_totalprice > 480000"))).select("c_custkey", "c_name")


@query("j20_anchored_panel", """WITH h AS (SELECT l_suppkey, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_tax, l_partkey::VARCHAR) AS k, round(100.0 * l_quantity / 50, 6) AS qcov FROM lineitem),
g AS (SELECT l_partkey AS og, max(CASE WHEN n_regionkey = 0 THEN 'Core' END) AS a, max(CASE WHEN n_regionkey = 1 THEN 'Core' END) AS b, max(CASE WHEN n_regionkey = 2 THEN 'Core' END) AS c, max(CASE WHEN n_regionkey = 3 THEN 'Core' END) AS d, max(CASE WHEN n_regionkey = 4 THEN 'Core' END) AS e FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY l_partkey)
SELECT l_suppkey AS gene, l_partkey AS og, qcov, s_name AS description, a AS class_0, b AS class_1, c AS class_2, d AS class_3, e AS class_4, a AS native_class FROM h JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN g ON og = l_partkey WHERE k = 1""")
def j20(t: Tables) -> DataFrame:
    hits = t.lineitem.select(F.lit("0").alias("species"), F.col("l_suppkey").alias("qseqid"), F.col("l_partkey").cast("string").alias("sseqid"), F.lit(90.0).alias("pident"), F.col("l_quantity").alias("length"), F.lit(50).alias("qlen"), F.col("l_extendedprice").alias("bitscore"), F.col("l_tax").alias("evalue"))
    members = t.part.select(F.col("p_partkey").cast("string").alias("protein"), F.col("p_partkey").alias("og"))
    panel = t.supplier.select(F.lit("0").alias("species"), F.col("s_suppkey").alias("gene"), F.col("s_name").alias("description"))
    classes = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("l_partkey").alias("og"), F.col("n_regionkey").cast("string").alias("species"), F.lit("Core").alias("class")).distinct()
    out = isolates.anchor_panel(panel, hits, members, classes, [*"01234"])
    return rounded(out.select("gene", "og", "qcov", "description", *[f"class_{k}" for k in range(5)], "native_class"), "qcov")


@query("j26_coordinates", """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey / 2.0 WHEN s_nationkey < 10 THEN s_nationkey * 1.0 END AS lat, CASE WHEN s_suppkey % 3 = 0 THEN -s_suppkey / 4.0 WHEN s_nationkey < 10 THEN s_nationkey * 2.0 END AS lon, CASE WHEN s_suppkey % 3 = 0 THEN 'lat_lon' WHEN s_nationkey < 10 THEN 'manual' END AS coordinate_source FROM supplier""")
def j26(t: Tables) -> DataFrame:
    rows = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("s_name").alias("strain"), F.concat(F.lit("at "), F.col("n_name"), F.lit(" x")).alias("location"), F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws(" ", F.col("s_suppkey") / 2.0, F.lit("N"), F.col("s_suppkey") / 4.0, F.lit("W"))).otherwise("missing").alias("lat_lon"))
    manual = t.nation.where("n_nationkey < 10").select(F.concat(F.lit("at "), F.col("n_name"), F.lit(" x")).alias("name"), (F.col("n_nationkey") * 1.0).alias("lat"), (F.col("n_nationkey") * 2.0).alias("lon"))
    out = isolates.coordinates(rows, manual, manual.where("false"))
    return out.select("s_suppkey", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "coordinate_source")


@query("j27_without_mirrors", "SELECT c_custkey, accession FROM (SELECT c_custkey, 'GCA_' || lpad(c_custkey::VARCHAR, 9, '0') || '.1' AS accession FROM customer) WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def j27(t: Tables) -> DataFrame:
    name = lambda c, p: F.concat(F.lit(p), F.lpad(F.col(c).cast("string"), 9, "0"), F.lit(".1"))
    genbank = t.customer.select("c_custkey", name("c_custkey", "GCA_").alias("accession"))
    return isolates.without_mirrors(genbank, t.supplier.select(name("s_suppkey", "GCF_").alias("accession")))


@query("j28_edge_test", "SELECT l_orderkey, l_linenumber, l_quantity <= 3 OR 50 - l_quantity <= 3 AS at_edge FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'")
def j28(t: Tables) -> DataFrame:
    contigs = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = t.lineitem.join(contigs, "l_orderkey")
    return rows.select("l_orderkey", "l_linenumber", ((F.col("l_quantity") <= 3) | (50 - F.col("l_quantity") <= 3)).alias("at_edge"))


@query("p7_identity_check", "SELECT s_suppkey, s_acctbal AS ani, coalesce(s_acctbal, -1) >= 95 AS same_species FROM supplier")
def p7(t: Tables) -> DataFrame:
    rows = t.supplier.select(F.col("s_suppkey").alias("accession"))
    ani = t.supplier.select(F.col("s_suppkey").alias("accession"), F.col("s_acctbal").alias("ani"))
    return isolates.identity_check(rows, ani).withColumnRenamed("accession", "s_suppkey")


@query("t40_cache_reconcile", "SELECT coalesce(s_suppkey, c_custkey) AS k, CASE WHEN c_custkey IS NULL THEN 'missing' WHEN s_suppkey IS NULL THEN 'extra' ELSE 'cached' END AS state FROM (SELECT s_suppkey FROM supplier) FULL JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON s_suppkey = c_custkey")
def t40(t: Tables) -> DataFrame:
    return isolates.cache_reconcile(t.supplier.select(F.col("s_suppkey").alias("k")), t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("x3_gene_checks", "SELECT l_orderkey AS contig, count(*) AS n, count(*) - count(DISTINCT l_partkey) AS n_duplicate, bool_or(o_orderkey IS NULL) AS orphan FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey")
def x3(t: Tables) -> DataFrame:
    n = t.lineitem.count()
    lines, contigs = relational.dealt(t.lineitem.select("l_orderkey", "l_partkey"), n, "l_orderkey"), relational.dealt(t.orders.select("o_orderkey"), n, "o_orderkey")
    rows = lines.join(contigs, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.groupBy(F.col("l_orderkey").alias("contig")).agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.countDistinct("l_partkey")).alias("n_duplicate"), F.bool_or(F.col("o_orderkey").isNull()).alias("orphan"))


