"""Queries that put several operators together: summaries, overlaps, rechecks and sinks read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.operators import association, convergence, figures, isolates, kinship, pangenome, relational, tree
from hyphalake.plans.base import Tables, query, rounded
from hyphalake.plans.joins import RESULTS, results
from hyphalake.plans.statistics import FITCH, features, region_tree, tip_states
from hyphalake.sources import store
from hyphalake.sources.shared import shared_folder


def folder(t: Tables) -> str:
    """A folder of this run where sinks may write."""
    return f"{shared_folder(t.spark)}/sinks-{uuid.uuid4().hex}"


YATES = """WITH g AS (SELECT s_suppkey AS sample, (n_regionkey >= 3)::INT AS is_case FROM supplier JOIN nation ON s_nationkey = n_nationkey), n AS (SELECT sum(is_case) AS n1, count(*) AS n FROM g),
h AS (SELECT l_partkey AS feature, sum(is_case)::BIGINT AS a, sum(1 - is_case)::BIGINT AS c FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN g ON l_suppkey = sample GROUP BY l_partkey),
x AS (SELECT feature, a, (n1 - a)::BIGINT AS b, c, (n - n1 - c)::BIGINT AS d FROM h, n)"""


def cases(t: Tables) -> DataFrame:
    return t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("sample"), (F.col("n_regionkey") >= 3).cast("int").alias("is_case"))


@query("t10_plain_association", f"{YATES} SELECT feature, a, b, c, d, round((a + b + c + d) * power(greatest(0, abs(a * d - b * c) - (a + b + c + d) / 2.0), 2) / nullif((a + b) * (c + d) * (a + c) * (b + d), 0)::DOUBLE, 6) AS chi2 FROM x")
def t10(t: Tables) -> DataFrame:
    values = t.lineitem.select(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("sample"), F.lit(1).alias("value"))
    return rounded(association.plain_association(values, cases(t)), "chi2")


@query("a14_case_control_means", f"{YATES} SELECT feature, round(a / (a + b), 6) AS case_mean, round(c / (c + d), 6) AS control_mean FROM x")
def a14(t: Tables) -> DataFrame:
    values = t.lineitem.select(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("sample"), F.lit(1).alias("value"))
    x = association.plain_association(values, cases(t))
    return rounded(x.select("feature", (F.col("a") / (F.col("a") + F.col("b"))).alias("case_mean"), (F.col("c") / (F.col("c") + F.col("d"))).alias("control_mean")), "case_mean", "control_mean")


@query("a26_result_summary", f"{RESULTS}, r AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY pvalue, og) AS k FROM res) SELECT species, count(*) AS n_tests, count(*) FILTER (pvalue < 0.2) AS n_significant, string_agg(og::VARCHAR, '; ' ORDER BY k) FILTER (k <= 5) AS top_features FROM r GROUP BY species")
def a26(t: Tables) -> DataFrame:
    rows = results(t).withColumnRenamed("og", "feature").withColumn("significant", F.col("pvalue") < 0.2)
    return association.result_summary(rows, ["species"])


@query("a31_reading_frames", "SELECT l_returnflag, count(*) AS n, round(100 * avg((l_linenumber > 1 AND l_tax > 0 AND l_discount > 0.02)::INT), 6) AS pct_complete, round(100 * avg((l_quantity <= 5 OR 50 - l_quantity <= 5)::INT), 6) AS pct_edge FROM lineitem GROUP BY l_returnflag")
def a31(t: Tables) -> DataFrame:
    genes = t.lineitem.select("l_returnflag", F.col("l_orderkey").alias("contig"), F.col("l_quantity").alias("start"), F.col("l_quantity").alias("end"), (F.col("l_linenumber") > 1).alias("starts"), (F.col("l_tax") > 0).alias("stops"), (F.col("l_discount") > 0.02).alias("in_frame"))
    lengths = t.lineitem.select(F.col("l_orderkey").alias("contig")).distinct().withColumn("length", F.lit(50.0))
    return rounded(isolates.reading_frames(genes, lengths, ["l_returnflag"], 5), "pct_complete", "pct_edge")


@query("o5_top_families", "SELECT family, total FROM (SELECT p_brand AS family, count(*) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand) ORDER BY total DESC, family LIMIT 10")
def o5(t: Tables) -> DataFrame:
    n = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("family")).agg(F.count(F.lit(1)).alias("total"))
    return n.orderBy(F.desc("total"), "family").limit(10)


@query("o9_first_per_group", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 3")
def o9(t: Tables) -> DataFrame:
    return relational.best_row(t.documents, ["source"], [F.col("doc_id")], 3).select("source", "doc_id")


@query("o10_leaf_order")
def o10(t: Tables) -> DataFrame:
    names, z = kinship.vector_matrix(t.embeddings, "vec_id", "embedding")
    order = kinship.leaf_order(names, None, kinship.vector_linkage(z))
    return t.spark.createDataFrame([(k, int(s)) for k, s in enumerate(order)], "place int, sample long")


@query("g8_linkage")
def g8(t: Tables) -> DataFrame:
    names, z = kinship.vector_matrix(t.embeddings, "vec_id", "embedding")
    return kinship.linkage_table(t.spark, names, None, kinship.vector_linkage(z))


@query("u7_layer_union", "SELECT l_partkey AS og FROM lineitem WHERE l_returnflag = 'A' UNION SELECT l_partkey FROM lineitem WHERE l_linestatus = 'O' AND l_tax > 0.05")
def u7(t: Tables) -> DataFrame:
    a = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("og"))
    return a.union(t.lineitem.where("l_linestatus = 'O' and l_tax > 0.05").select("l_partkey")).distinct()


@query("t24_best_per_combined", f"{RESULTS}, l AS (SELECT DISTINCT l_partkey AS og, o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT species, c AS combined_og, min(pvalue) AS pvalue FROM res JOIN l USING (og) GROUP BY species, c")
def t24(t: Tables) -> DataFrame:
    from hyphalake.plans.joins import links

    moved = convergence.transfer(results(t), links(t))
    return convergence.merge_results(moved, ["species", "combined_og"], "best").select("species", "combined_og", "pvalue")


@query("t28_family_overlap", "WITH m AS (SELECT DISTINCT n_regionkey AS species, p_brand || '/' || n_regionkey AS family, o_custkey AS og FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) SELECT x.family AS family_a, y.family AS family_b, count(*) AS n_shared FROM m x JOIN m y ON x.og = y.og AND x.species < y.species GROUP BY 1, 2")
def t28(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return convergence.shared_between_families(rows.select(F.col("n_regionkey").alias("species"), F.concat_ws("/", "p_brand", "n_regionkey").alias("family"), F.col("o_custkey").alias("og")))


@query("t30_colocalised_hits", "SELECT o_orderkey AS area, count(DISTINCT l_partkey) AS n_features, count(DISTINCT l_partkey) FILTER (l_partkey % 10 = 0) AS n_significant FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 2000 DAY GROUP BY o_orderkey HAVING count(*) FILTER (l_partkey % 10 = 0) > 0")
def t30(t: Tables) -> DataFrame:
    areas = t.orders.select(F.col("o_orderkey").alias("contig"), F.col("o_orderkey").alias("area"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 2000 days")).alias("end"))
    genes = t.lineitem.select(F.col("l_orderkey").alias("contig"), F.col("l_partkey").alias("og"), F.col("l_shipdate").alias("start"), F.col("l_shipdate").alias("end"))
    inside = relational.interval_overlap(areas, genes, ["contig"])
    out = inside.groupBy("area").agg(F.countDistinct("og_r").alias("n_features"), F.countDistinct(F.when(F.col("og_r") % 10 == 0, F.col("og_r"))).alias("n_significant"))
    return out.where("n_significant > 0")


@query("t37_foreign_hits", "WITH b AS (SELECT l_returnflag AS species, l_partkey AS og, l_tax, l_suppkey, row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_tax, l_discount DESC, CASE WHEN l_suppkey % 3 = 0 THEN 'Bacillus' WHEN l_suppkey % 3 = 1 THEN 'fungi sp.' ELSE 'thing' END) AS k, CASE WHEN l_suppkey % 3 = 0 THEN 'Bacteria' WHEN l_suppkey % 3 = 1 THEN 'Other fungi' ELSE 'Unknown' END AS kd FROM lineitem) SELECT species, og, CASE WHEN l_tax <= 0.01 THEN kd ELSE 'No confident hit' END AS kingdom, l_tax <= 0.01 AND kd = 'Bacteria' AS is_foreign FROM b WHERE k = 1")
def t37(t: Tables) -> DataFrame:
    organism = F.when(F.col("l_suppkey") % 3 == 0, "Bacillus").when(F.col("l_suppkey") % 3 == 1, "fungi sp.").otherwise("thing")
    hits = t.lineitem.select(F.col("l_returnflag").alias("species"), F.col("l_partkey").alias("og"), F.col("l_tax").alias("evalue"), F.col("l_discount").alias("pident"), organism.alias("organism"))
    return isolates.foreign_hits(hits, 0.01).select("species", "og", "kingdom", "is_foreign")


@query("t39_alignment_classes", "WITH b AS (SELECT l_partkey AS og, l_quantity, l_discount, l_tax, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_tax, l_suppkey::VARCHAR) AS k FROM lineitem) SELECT p_partkey AS og, CASE WHEN k IS NULL THEN 'No hit' WHEN l_quantity * 2 >= 70 AND l_discount * 1000 >= 30 AND l_tax * 1000 >= 70 THEN 'Full-length' WHEN l_quantity * 2 >= 70 AND l_discount * 1000 >= 30 AND l_tax * 1000 < 50 THEN 'Fragment' ELSE 'No significant similarity' END AS hit_class FROM part LEFT JOIN b ON og = p_partkey AND k = 1")
def t39(t: Tables) -> DataFrame:
    return aligned(t, t.lineitem)


def aligned(t: Tables, lines: DataFrame) -> DataFrame:
    hits = lines.select(F.col("l_partkey").alias("og"), F.col("l_suppkey").cast("string").alias("sseqid"), (F.col("l_quantity") * 2).alias("qcov"), (F.col("l_tax") * 1000).alias("scov"), (F.col("l_discount") * 1000).alias("pident"), F.col("l_extendedprice").alias("bitscore"), F.col("l_tax").alias("evalue"))
    return isolates.aligned_classes(t.part.select(F.col("p_partkey").alias("og")), hits).select("og", "hit_class")


@query("t43_groups_with_many", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_rare FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey HAVING count(DISTINCT l_partkey) > 150")
def t43(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_rare")).where("n_rare > 150")


@query("t44_sister_recheck", "WITH s AS (SELECT l_orderkey AS k, l_suppkey, l_quantity * 2 AS ani, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_suppkey) AS r FROM lineitem) SELECT o_orderkey AS accession, l_suppkey AS reference, ani AS sister_ani, coalesce(ani >= 95, false) AS is_match FROM orders LEFT JOIN s ON k = o_orderkey AND r = 1 WHERE o_orderstatus = 'O'")
def t44(t: Tables) -> DataFrame:
    failed = t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("accession"))
    sisters = t.lineitem.select(F.col("l_orderkey").alias("accession"), F.col("l_suppkey").alias("reference"), (F.col("l_quantity") * 2).alias("ani"))
    return isolates.recheck(failed, sisters)


@query("g4_ancestral_sets", FITCH.split("SELECT og, (sum(ch)")[0].rstrip().removesuffix(")") + ") SELECT og, bit_or(m)::BIGINT AS every, bit_and(m)::BIGINT AS common FROM g2 GROUP BY og")
def g4(t: Tables) -> DataFrame:
    sets = tree.downpass(region_tree(t), features(t), tip_states(t), default=0, depth=1)
    return sets.groupBy("og").agg(F.bit_or("mask").alias("every"), F.bit_and("mask").alias("common"))


@query("j5_class_of_rows", "WITH {members} SELECT l_orderkey, l_linenumber, pangenome_class FROM lineitem JOIN classes ON l_partkey = og")
def j5(t: Tables) -> DataFrame:
    from hyphalake.plans.aggregates import classes

    return t.lineitem.join(classes(t), F.col("l_partkey") == F.col("og")).select("l_orderkey", "l_linenumber", "pangenome_class")


@query("j9_merge_rule_sensitivity", f"""{RESULTS}, l AS (SELECT DISTINCT l_partkey AS og, o_custkey % 300 AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey), m AS (SELECT species, c, arg_min(beta, (pvalue, beta)) AS best, median(beta) AS med FROM res JOIN l USING (og) WHERE species IN ('ASIA', 'EUROPE') GROUP BY species, c),
p AS (SELECT x.c, x.best AS b1, y.best AS b2, x.med AS m1, y.med AS m2 FROM m x JOIN m y USING (c) WHERE x.species = 'ASIA' AND y.species = 'EUROPE')
SELECT 'best' AS rule, count(*) FILTER (b1 <> 0 AND b2 <> 0) AS n, count(*) FILTER (b1 <> 0 AND b2 <> 0 AND sign(b1) = sign(b2)) AS n_same FROM p UNION ALL SELECT 'median', count(*) FILTER (m1 <> 0 AND m2 <> 0), count(*) FILTER (m1 <> 0 AND m2 <> 0 AND sign(m1) = sign(m2)) FROM p""")
def j9(t: Tables) -> DataFrame:
    from hyphalake.plans.joins import links

    near = links(t).select("og", (F.col("combined_og") % 300).alias("combined_og")).distinct()
    moved = convergence.transfer(results(t), near)
    out = None
    for rule in ("best", "median"):
        m = convergence.merge_results(moved, ["species", "combined_og"], rule)
        x, y = (m.where(F.col("species") == s).select("combined_og", F.col("beta").alias(b)) for s, b in (("ASIA", "beta_a"), ("EUROPE", "beta_b")))
        got = convergence.direction_agreement(x.join(y, "combined_og")).select(F.lit(rule).alias("rule"), "n", "n_same")
        out = got if out is None else out.unionByName(got)
    return out


@query("j18_burden_with_sizes", "WITH {members} SELECT g.genome, species, count(*) AS total, s_acctbal AS size FROM pav JOIN genomes g ON pav.genome = g.genome JOIN supplier ON s_suppkey = g.genome GROUP BY g.genome, g.species, s_acctbal".replace("SELECT g.genome, species", "SELECT g.genome, g.species"))
def j18(t: Tables) -> DataFrame:
    n = t.pav().groupBy("genome").agg(F.count(F.lit(1)).alias("total"))
    return n.join(t.genomes(), "genome").join(t.supplier, F.col("genome") == F.col("s_suppkey"), "left").select("genome", "species", "total", F.col("s_acctbal").alias("size"))


@query("j24_first_label_match", "SELECT s_suppkey, min(c_custkey) AS c_custkey FROM supplier JOIN customer ON regexp_extract(s_name, '#([0-9]+)', 1) = regexp_extract(c_name, '#([0-9]+)', 1) GROUP BY s_suppkey")
def j24(t: Tables) -> DataFrame:
    norm = lambda c: F.regexp_extract(c, "#([0-9]+)", 1)
    both = t.supplier.join(t.customer, norm("s_name") == norm("c_name"))
    return both.groupBy("s_suppkey").agg(F.min("c_custkey").alias("c_custkey"))


@query("k1_partitioned_results", f"{RESULTS} SELECT species, count(*) AS n, round(sum(pvalue), 4) AS p_sum FROM res GROUP BY species")
def k1(t: Tables) -> DataFrame:
    path = f"{folder(t)}/results"
    store.write_partitioned(results(t), path, ["species"])
    return rounded(t.spark.read.parquet(path).groupBy(F.col("species").cast("string").alias("species")).agg(F.count(F.lit(1)).alias("n"), F.sum("pvalue").alias("p_sum")), "p_sum", digits=4)


@query("k6_resumed_append", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 < 3")
def k6(t: Tables) -> DataFrame:
    path = f"{folder(t)}/done"
    work = lambda df: df.select("o_orderkey", "o_totalprice")
    store.append_missing(t.orders.where("o_orderkey % 4 = 0"), path, ["o_orderkey"], work)
    store.append_missing(t.orders.where("o_orderkey % 4 < 3"), path, ["o_orderkey"], work)
    return t.spark.read.parquet(path)


@query("k5_cached_summary", """WITH s AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS dear FROM orders GROUP BY 1)
SELECT r AS step, built, o_orderpriority AS priority, CASE r WHEN 1 THEN f WHEN 2 THEN f WHEN 3 THEN n ELSE dear END AS n FROM s, (VALUES (1, 1), (2, 1), (3, 2), (4, 3)) v(r, built) WHERE CASE r WHEN 1 THEN f WHEN 2 THEN f WHEN 3 THEN n ELSE dear END > 0""")
def k5(t: Tables) -> DataFrame:
    """A summary read four times: made, as it stands, after its input changed, and after its parameter changed."""
    root, built, out = folder(t), [], None

    def read(step: int, above: float) -> DataFrame:
        def build() -> DataFrame:
            built.append(step)
            return t.spark.read.parquet(f"{root}/input").where(F.col("o_totalprice") > above).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))

        rows = store.cached(t.spark, f"{root}/summary", build, inputs=[f"{root}/input"], parameters={"above": above})
        # Kept beside the cache, as the next step may build that again.
        rows.select(F.lit(step).alias("step"), F.lit(len(built)).alias("built"), "priority", "n").write.parquet(f"{root}/read/at={step}")
        return t.spark.read.parquet(f"{root}/read/at={step}")

    t.orders.where("o_orderstatus = 'F'").write.parquet(f"{root}/input")
    steps = [read(1, -1.0), read(2, -1.0)]
    t.orders.write.mode("overwrite").parquet(f"{root}/input")
    steps += [read(3, -1.0), read(4, 100_000.0)]
    for s in steps:
        out = s if out is None else out.unionByName(s)
    return out


@query("k7_classified_outputs", "SELECT 'all' AS part, count(*) AS n FROM customer UNION ALL SELECT 'known', count(*) FILTER (c_mktsegment <> 'MACHINERY') FROM customer UNION ALL SELECT 'association', count(*) FILTER (c_mktsegment <> 'MACHINERY') FROM customer")
def k7(t: Tables) -> DataFrame:
    paths = store.save_classified(t.customer, folder(t), "c_mktsegment", ["MACHINERY"])
    out = None
    for name, path in paths.items():
        n = t.spark.read.parquet(path).agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@query("v2_preflight", "SELECT 'there' AS name, true AS present UNION ALL SELECT 'missing', false")
def v2(t: Tables) -> DataFrame:
    path = folder(t)
    t.region.write.parquet(f"{path}/there")
    return store.preflight(t.spark, {"there": f"{path}/there", "missing": f"{path}/missing"}).select("name", "present")


@query("s21_first_existing", "SELECT r_regionkey, r_name FROM region")
def s21(t: Tables) -> DataFrame:
    path = folder(t)
    t.region.write.parquet(f"{path}/second")
    return store.first_existing(t.spark, [f"{path}/first", f"{path}/second"]).select("r_regionkey", "r_name")


@query("s24_species_data", "WITH {members}, kept AS (SELECT pav.* FROM pav WHERE og NOT IN (SELECT og FROM pav GROUP BY og HAVING bool_and(genome % 7 = 0)) AND genome % 7 <> 0) SELECT og, count(*) AS n_genomes FROM kept GROUP BY og")
def s24(t: Tables) -> DataFrame:
    gone = t.supplier.where("s_suppkey % 7 = 0").select(F.col("s_suppkey").alias("genome"))
    pav = t.pav()
    kept = pav.join(pangenome.private_features(pav, gone), "og", "left_anti").join(F.broadcast(gone), "genome", "left_anti")
    return pangenome.frequency(kept)


@query("v1_quality_points", """WITH r AS (SELECT s_suppkey AS accession, r_name AS species, s_acctbal AS contigs, CASE WHEN s_suppkey % 4 > 0 THEN s_nationkey END AS n50, s_acctbal > 2000 AS passed, CASE s_suppkey % 9 WHEN 0 THEN 'genome' WHEN 1 THEN 'proteome' WHEN 2 THEN 'both' END AS ref, s_suppkey % 5 = 0 AS gone FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT *, 'passed' AS state FROM r WHERE passed AND ref IS NULL UNION ALL SELECT *, 'filtered' FROM r WHERE NOT passed AND ref IS NULL AND NOT gone UNION ALL SELECT *, 'excluded' FROM r WHERE gone UNION ALL SELECT *, 'reference ' || ref FROM r WHERE ref IS NOT NULL)
SELECT species, accession, 'contigs' AS metric, state, contigs::DOUBLE AS value FROM s UNION ALL SELECT species, accession, 'n50', state, n50::DOUBLE FROM s WHERE n50 IS NOT NULL""")
def v1_quality(t: Tables) -> DataFrame:
    genomes = t.genomes().select(F.col("genome").alias("accession"), "species")
    kinds = F.when(F.col("s_suppkey") % 9 == 0, "genome").when(F.col("s_suppkey") % 9 == 1, "proteome").when(F.col("s_suppkey") % 9 == 2, "both")
    rows = genomes.join(t.supplier, F.col("accession") == F.col("s_suppkey")).select("accession", "species", F.col("s_acctbal").alias("contigs"), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_nationkey")).alias("n50"), (F.col("s_acctbal") > 2000).alias("passed"), kinds.alias("reference_type"))
    return figures.quality_points(rows, ["contigs", "n50"], rows.where("accession % 5 = 0").select("species", "accession"))


@query("v1_map_marginals", """WITH p AS (SELECT c_mktsegment AS species, c_nationkey * 15.0 - 180 AS lon, c_acctbal / 50 - 40 AS lat FROM customer), a AS (SELECT 'lon' AS axis, species, least(71, floor((lon + 180) / 360 * 72))::INT AS bin, -180.0 AS low, 5.0 AS step FROM p WHERE lon BETWEEN -180 AND 180 UNION ALL SELECT 'lat', species, least(35, floor((lat + 90) / 180 * 36))::INT, -90.0, 5.0 FROM p WHERE lat BETWEEN -90 AND 90)
SELECT axis, species, bin, (any_value(low) + bin * any_value(step))::DOUBLE AS start, count(*) AS n FROM a GROUP BY axis, species, bin""")
def v1_marginals(t: Tables) -> DataFrame:
    places = t.customer.select(F.col("c_mktsegment").alias("species"), (F.col("c_nationkey") * 15.0 - 180).alias("lon"), (F.col("c_acctbal") / 50 - 40).alias("lat"))
    return figures.map_marginals(places)
