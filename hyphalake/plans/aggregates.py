"""Presence and copy number, classes, consensus and the other grouped aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.operators import burden, isolates, pangenome, relational
from hyphalake.plans.base import CORE_N, RARE_N, Tables, query, rounded

PARTS = "SELECT p_partkey AS og, p_name || ';' || p_type AS terms, p_brand AS brand, p_type AS kind FROM part"


def classes(t: Tables) -> DataFrame:
    freq = pangenome.frequency(t.pav())
    total = F.broadcast(t.supplier.agg(F.count(F.lit(1)).alias("_total")))  # one row
    cut = pangenome.pangenome_class(F.col("n_genomes"), F.least(F.lit(CORE_N), "_total"), F.least(F.lit(RARE_N), F.expr("_total * 4 div 5")))
    return freq.crossJoin(total).withColumn("pangenome_class", cut).drop("_total")


@query("a2_presence", "WITH {members} SELECT og, genome FROM pav")
def a2(t: Tables) -> DataFrame:
    return pangenome.presence(t.lineitem.select(F.col("l_partkey").alias("og"), F.col("l_suppkey").alias("genome")))


@query("a3_copy_number", "WITH {members} SELECT og, genome, count(*) AS copies FROM members GROUP BY og, genome")
def a3(t: Tables) -> DataFrame:
    return pangenome.copy_number(t.lineitem.select(F.col("l_partkey").alias("og"), F.col("l_suppkey").alias("genome")))


@query("a4_family_copy_number", "SELECT p_brand AS family, l_suppkey AS strain, count(*) AS copies, 1 AS present FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_suppkey")
def a4(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("family"), F.col("l_suppkey").alias("strain"))
    return pangenome.copy_number(rows, "family", "strain").withColumn("present", F.lit(1))


@query("k4_wide_export", "SELECT p_brand AS family, " + ", ".join(f"count(DISTINCT CASE WHEN l_suppkey = {g} THEN l_suppkey END)::INT AS \"{g}\"" for g in range(10)) + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand")
def k4(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("family"), F.col("l_suppkey").alias("strain"))
    return pangenome.wide(pangenome.presence(rows, "family", "strain"), "family", "strain", range(10), F.first(F.lit(1)))


@query("k4_wide_export_whole")
def k4_whole(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("family"), F.col("l_suppkey").alias("strain"))
    strains = sorted(r.s_suppkey for r in t.supplier.select("s_suppkey").collect())
    return pangenome.wide_presence(pangenome.presence(rows, "family", "strain"), "family", "strain", strains)


@query("a5_quality_cuts", """
SELECT CAST(floor(median(l_quantity)) AS BIGINT) AS contigs_median,
       (SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice LIMIT 1 OFFSET (SELECT greatest(1, CAST(floor(count(*) * 0.75) AS BIGINT)) - 1 FROM lineitem)) AS n50_p75
FROM lineitem""")
def a5(t: Tables) -> DataFrame:
    return isolates.quality_cuts(t.lineitem, "l_quantity", "l_extendedprice")


@query("p8_passing_rows", """
WITH c AS (SELECT CAST(floor(median(l_quantity)) AS BIGINT) AS m, (SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice LIMIT 1 OFFSET (SELECT greatest(1, CAST(floor(count(*) * 0.75) AS BIGINT)) - 1 FROM lineitem)) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem, c WHERE l_quantity <= m AND l_extendedprice >= q AND l_discount > 0.05""")
def p8(t: Tables) -> DataFrame:
    cuts = isolates.quality_cuts(t.lineitem, "l_quantity", "l_extendedprice")
    return isolates.passing(t.lineitem, cuts, 0.05, "l_quantity", "l_extendedprice", "l_discount").select("l_orderkey", "l_linenumber", "l_quantity")


@query("a6_frequency_histogram", "WITH {members} SELECT n::BIGINT AS n_genomes, count(og) AS n_features FROM generate_series(1, 100) g(n) LEFT JOIN freq ON n_genomes = n GROUP BY n")
def a6(t: Tables) -> DataFrame:
    return pangenome.frequency_histogram(pangenome.frequency(t.pav()), 100)


@query("t3_pangenome_class", "WITH {members} SELECT og, n_genomes, pangenome_class FROM classes")
def t3(t: Tables) -> DataFrame:
    return classes(t)


@query("a7_class_composition", "WITH {members} SELECT pangenome_class, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM classes GROUP BY pangenome_class")
def a7(t: Tables) -> DataFrame:
    return rounded(pangenome.composition(classes(t)), "pct")


@query("a8_consensus_terms", """
WITH p AS (SELECT l_partkey % 50 AS og, unnest(list_distinct(list_filter(list_transform(string_split_regex(p_name || ';' || p_type, '[;,|]'), lambda x: trim(x)), lambda x: x <> ''))) AS term FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT og, term, count(*) AS support FROM p GROUP BY og, term),
n AS (SELECT l_partkey % 50 AS og, count(*) AS n_proteins FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY og ORDER BY support DESC, term) AS k FROM c)
SELECT r.og, 'terms' AS layer, term, support, n_proteins, support >= n_proteins * 0.5 AS is_majority FROM r JOIN n ON r.og = n.og WHERE k = 1""")
def a8(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select((F.col("l_partkey") % 50).alias("og"), F.concat_ws(";", "p_name", "p_type").alias("terms"))
    return pangenome.consensus(rows, ["og"], ["terms"])


@query("a9_consensus_table", """
WITH p AS (SELECT l_partkey % 50 AS og, p_brand, p_type, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT og, p_brand AS v, row_number() OVER (PARTITION BY og ORDER BY count(*) DESC, p_brand) AS k FROM p GROUP BY og, p_brand),
y AS (SELECT og, p_type AS v, row_number() OVER (PARTITION BY og ORDER BY count(*) DESC, p_type) AS k FROM p GROUP BY og, p_type),
s AS (SELECT og, count(*) AS n_proteins, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) AS signal_fraction FROM p GROUP BY og)
SELECT s.og, b.v AS p_brand, y.v AS p_type, n_proteins, signal_fraction, signal_fraction >= 0.33 AS is_secreted FROM s JOIN b ON s.og = b.og AND b.k = 1 JOIN y ON s.og = y.og AND y.k = 1""")
def a9(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select((F.col("l_partkey") % 50).alias("og"), "p_brand", "p_type", "l_returnflag")
    terms = pangenome.consensus_wide(pangenome.consensus(rows, ["og"], ["p_brand", "p_type"]), ["og"], ["p_brand", "p_type"])
    flags = rows.groupBy("og").agg(F.count(F.lit(1)).alias("n_proteins"), F.round(F.avg((F.col("l_returnflag") == "R").cast("int")), 6).alias("signal_fraction"))
    return terms.join(flags, "og").withColumn("is_secreted", F.col("signal_fraction") >= 0.33)


@query("a13_annotation_rate", "SELECT event_type, count(*) AS n, round(100 * avg(CASE WHEN trim(coalesce(json_extract_string(props, '$.k'), '')) IN ('', '-', 'nan') THEN 0 ELSE 1 END), 6) AS pct FROM events GROUP BY event_type")
def a13(t: Tables) -> DataFrame:
    rows = t.events.withColumn("k", F.get_json_object("props", "$.k"))
    return rounded(burden.annotation_rate(rows, "k", ["event_type"]), "pct")


@query("a12_length_summary", "WITH m AS (SELECT lang, source, median(length(text)) AS m FROM documents GROUP BY lang, source) SELECT lang, count(*) AS n, round(avg(m), 4) AS mean, round(median(m), 4) AS median, round(stddev_samp(m), 4) AS sd FROM m GROUP BY lang")
def a12(t: Tables) -> DataFrame:
    rows = t.documents.select("lang", F.col("source").alias("og"), F.length("text").alias("length"))
    return rounded(burden.length_summary(rows, ["lang"]), "mean", "median", "sd", digits=4)


@query("a15_genome_burden", """WITH {members}
SELECT genome, count(*) FILTER (pangenome_class = 'Core') AS core, count(*) FILTER (pangenome_class = 'Accessory') AS accessory, count(*) FILTER (pangenome_class = 'Rare') AS rare, count(*) AS total
FROM pav JOIN classes ON pav.og = classes.og GROUP BY genome""")
def a15(t: Tables) -> DataFrame:
    return burden.genome_burden(t.pav(), classes(t), [])


@query("a16_burden_summary", """WITH {members}, b AS (SELECT genome, species, count(*) FILTER (pangenome_class = 'Rare') AS rare FROM pav JOIN classes ON pav.og = classes.og GROUP BY genome, species)
SELECT species, round(avg(rare), 6) AS mean, round(stddev_samp(rare), 6) AS sd, count(*) AS n FROM b GROUP BY species""")
def a16(t: Tables) -> DataFrame:
    b = burden.genome_burden(t.pav(), classes(t), []).join(t.genomes(), "genome")
    return rounded(burden.burden_summary(b, ["species"]), "mean", "sd")


@query("a17_crosstab_margins", "SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'All' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN grouping(n_name) = 1 THEN 'All' ELSE n_name END AS n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (c_mktsegment, n_name)")
def a17(t: Tables) -> DataFrame:
    return relational.crosstab_margins(t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")), "c_mktsegment", "n_name")


@query("a18_pivot_counts", "SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) FILTER (l_returnflag = 'A') AS \"A\", count(*) FILTER (l_returnflag = 'N') AS \"N\", count(*) FILTER (l_returnflag = 'R') AS \"R\", count(*) AS total FROM lineitem GROUP BY 1")
def a18(t: Tables) -> DataFrame:
    return relational.pivot_counts(t.lineitem.withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd")), ["day"], "l_returnflag", ["A", "N", "R"], "total")


@query("a19_family_by_species", """WITH {members}, f AS (SELECT DISTINCT species, og FROM members)
SELECT p_brand AS family, count(*) FILTER (species = 'AFRICA') AS "AFRICA", count(*) FILTER (species = 'AMERICA') AS "AMERICA", count(*) FILTER (species = 'ASIA') AS "ASIA", count(*) FILTER (species IN ('AFRICA', 'AMERICA', 'ASIA')) AS total
FROM f JOIN part ON og = p_partkey WHERE species IN ('AFRICA', 'AMERICA', 'ASIA') GROUP BY p_brand""")
def a19(t: Tables) -> DataFrame:
    kinds = ["AFRICA", "AMERICA", "ASIA"]
    f = t.members().select("species", "og").distinct().where(F.col("species").isin(*kinds)).join(t.part, F.col("og") == F.col("p_partkey"))
    return relational.pivot_counts(f.withColumnRenamed("p_brand", "family"), ["family"], "species", kinds, "total")


@query("a20_flag_counts", "WITH {members} SELECT pangenome_class, count(*) AS n, count(*) FILTER (p_retailprice > 1500) AS n_flagged, round(avg(CASE WHEN p_retailprice > 1500 THEN 1.0 ELSE 0 END), 6) AS share FROM classes JOIN part ON og = p_partkey GROUP BY pangenome_class")
def a20(t: Tables) -> DataFrame:
    rows = classes(t).join(t.part, F.col("og") == F.col("p_partkey"))
    flag = F.col("p_retailprice") > 1500
    return rounded(rows.groupBy("pangenome_class").agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("n_flagged"), F.avg(flag.cast("double")).alias("share")), "share")


@query("a21_qc_summary", "SELECT n_name, count(*) AS n, count(*) FILTER (s_acctbal > 0) AS n_pass, round(100.0 * count(*) FILTER (s_acctbal > 0) / count(*), 6) AS pct_pass, round(median(s_acctbal), 6) AS median, min(s_acctbal) AS low, max(s_acctbal) AS high FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def a21(t: Tables) -> DataFrame:
    rows = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("ok", F.col("s_acctbal") > 0)
    return rounded(isolates.qc_summary(rows, ["n_name"], "ok", "s_acctbal"), "pct_pass", "median")


@query("a22_family_rollup", """
WITH r AS (SELECT p_brand AS family, l_orderkey AS record, l_suppkey AS strain, p_type AS class, l_returnflag AS category, l_partkey AS ref_id, l_extendedprice AS score FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT family, count(DISTINCT record) AS n_regions, count(DISTINCT strain) AS n_strains, string_agg(DISTINCT category, '; ' ORDER BY category) AS categories FROM r GROUP BY family),
m AS (SELECT family, class AS modal_class, round(count(*) / sum(count(*)) OVER (PARTITION BY family), 6) AS purity, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, class) AS k FROM r GROUP BY family, class),
h AS (SELECT family, ref_id, count(DISTINCT record) AS n, max(score) AS score FROM r GROUP BY family, ref_id),
g AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, score DESC, ref_id) AS k FROM h),
l AS (SELECT family, max(ref_id) FILTER (k = 1) AS top_id, max(n) FILTER (k = 1) AS top_n, string_agg(ref_id::VARCHAR, '; ' ORDER BY k) AS known_hits FROM g WHERE k <= 3 GROUP BY family)
SELECT b.family, n_regions, n_strains, categories, modal_class, purity, top_id, known_hits, round(top_n / n_regions, 6) AS support, top_n / n_regions >= 0.05 AS confident FROM b JOIN m ON b.family = m.family AND m.k = 1 JOIN l ON b.family = l.family""")
def a22(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("family"), F.col("l_orderkey").alias("record"), F.col("l_suppkey").alias("strain"), F.col("p_type").alias("class"), F.col("l_returnflag").alias("category"), F.lit(False).alias("is_reference"), F.col("l_partkey").alias("ref_id"), F.lit("").alias("compound"), F.col("l_extendedprice").alias("score"))
    out = isolates.family_rollup(rows, rows, min_support=0.05)
    return rounded(out.select("family", "n_regions", "n_strains", "categories", "modal_class", "purity", "top_id", "known_hits", "support", "confident"), "purity", "support")


@query("a25_association_summary", "SELECT event_type AS contrast, count(*) AS n_tested, count(*) FILTER (value < 5) AS n_significant, round(median(value), 6) AS median_stat FROM events GROUP BY event_type")
def a25(t: Tables) -> DataFrame:
    return rounded(t.events.groupBy(F.col("event_type").alias("contrast")).agg(F.count(F.lit(1)).alias("n_tested"), F.count_if(F.col("value") < 5).alias("n_significant"), F.median("value").alias("median_stat")), "median_stat")


def by_species(t: Tables) -> DataFrame:
    """(species, og, n_genomes)."""
    rows = relational.dealt(t.members().select("species", "og", "genome"), t.lineitem.count(), "og")
    return pangenome.frequency(pangenome.presence(rows, by=["species"]), by=["species"])


@query("a27_core_compartments", "WITH {members} SELECT species, count(*) FILTER (n = total) AS strict_core, count(*) FILTER (n >= total * 0.5 AND n < total) AS soft_core, count(*) AS n_features FROM (SELECT species, og, count(*) AS n FROM pav GROUP BY species, og) JOIN (SELECT species AS sp, count(*) AS total FROM genomes GROUP BY species) ON species = sp GROUP BY species")
def a27(t: Tables) -> DataFrame:
    total = t.genomes().groupBy("species").agg(F.count(F.lit(1)).alias("total"))
    n = by_species(t).join(F.broadcast(total), "species")
    return n.groupBy("species").agg(F.count_if(F.col("n_genomes") == F.col("total")).alias("strict_core"), F.count_if((F.col("n_genomes") >= F.col("total") * 0.5) & (F.col("n_genomes") < F.col("total"))).alias("soft_core"), F.count(F.lit(1)).alias("n_features"))


GENUS = """WITH {members}, total AS (SELECT species, count(*) AS total FROM genomes GROUP BY species), n AS (SELECT species, og, count(*) AS n FROM pav GROUP BY species, og),
g AS (SELECT o.og, t.species, coalesce(n.n, 0) AS n_genomes, CASE WHEN coalesce(n.n, 0) = 0 THEN 'Absent' WHEN n.n >= total * 0.5 THEN 'Core' WHEN n.n <= total * 0.1 THEN 'Rare' ELSE 'Accessory' END AS class
FROM (SELECT DISTINCT og FROM n) o CROSS JOIN total t LEFT JOIN n ON n.og = o.og AND n.species = t.species)"""


def genus(t: Tables) -> DataFrame:
    total = t.genomes().groupBy("species").agg(F.count(F.lit(1)).alias("total"))
    return pangenome.genus_classes(by_species(t), total, 0.5, 0.1)


@query("a28_genus_classes", f"{GENUS} SELECT og, species, n_genomes, class FROM g")
def a28(t: Tables) -> DataFrame:
    return genus(t)


@query("a30_conservation_histogram", f"{GENUS}, c AS (SELECT og, count(*) FILTER (class = 'Core') AS n_core FROM g GROUP BY og) SELECT n::BIGINT AS n_core, count(og) AS n_features FROM generate_series(0, 5) s(n) LEFT JOIN c ON c.n_core = n GROUP BY n")
def a30(t: Tables) -> DataFrame:
    c = genus(t).groupBy("og").agg(F.count_if(F.col("class") == "Core").alias("n_core"))
    every = t.spark.range(6).select(F.col("id").alias("n_core"))
    return every.join(c.groupBy("n_core").agg(F.count(F.lit(1)).alias("n_features")), "n_core", "left").na.fill(0)


@query("a29_best_class", "SELECT l_suppkey AS gene_group, max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS best, string_agg(DISTINCT l_linestatus, '; ' ORDER BY l_linestatus) AS origins FROM lineitem GROUP BY l_suppkey")
def a29(t: Tables) -> DataFrame:
    level = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    return t.lineitem.groupBy(F.col("l_suppkey").alias("gene_group")).agg(F.max(level).alias("best"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), "; ").alias("origins"))


@query("a32_fixed_pivot", "SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS total FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id")
def a32(t: Tables) -> DataFrame:
    kinds = ["click", "view", "purchase"]
    return relational.pivot_counts(t.events.where(F.col("event_type").isin(*kinds)), ["user_id"], "event_type", kinds, "total")


@query("a33_describe", "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, min(value) AS low, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS high FROM events GROUP BY event_type")
def a33(t: Tables) -> DataFrame:
    q = lambda p: F.round(F.percentile("value", F.lit(p)), 6)
    return t.events.groupBy("event_type").agg(F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("sd"), F.min("value").alias("low"), q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"), F.max("value").alias("high"))


@query("a34_letters", "SELECT letter, count(*) AS n FROM (SELECT unnest(string_split(upper(p_name), '')) AS letter FROM part) WHERE letter BETWEEN 'A' AND 'Z' GROUP BY letter")
def a34(t: Tables) -> DataFrame:
    return t.part.select(F.explode(F.split(F.upper("p_name"), "")).alias("letter")).where("letter between 'A' and 'Z'").groupBy("letter").agg(F.count(F.lit(1)).alias("n"))


@query("a35_distinct_counts", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_features, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey")
def a35(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_features"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("a37_term_union", "WITH {members} SELECT species, count(DISTINCT w) AS n_terms, string_agg(DISTINCT w, ',' ORDER BY w) AS terms FROM (SELECT DISTINCT species, og FROM members) JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) ON og = p_partkey GROUP BY species")
def a37(t: Tables) -> DataFrame:
    terms = t.part.select(F.col("p_partkey").alias("og"), F.explode(F.split("p_name", " ")).alias("w"))
    rows = t.members().select("species", "og").distinct().join(terms, "og").select("species", "w").distinct()
    return rows.groupBy("species").agg(F.count(F.lit(1)).alias("n_terms"), F.array_join(F.array_sort(F.collect_list("w")), ",").alias("terms"))


@query("a1_ordered_distinct_concat", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag AS v, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) AS k FROM lineitem)
SELECT l_orderkey, string_agg(v, ', ' ORDER BY l_linenumber, v) AS flags FROM (SELECT l_orderkey, v, min(l_linenumber) AS l_linenumber FROM r GROUP BY l_orderkey, v) GROUP BY l_orderkey""")
def a1(t: Tables) -> DataFrame:
    seen = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))), lambda x: x["l_returnflag"]))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(seen, ", ").alias("flags"))


@query("v1_histogram", "SELECT b::INT AS bin, round(b * 5.0::DOUBLE, 6) AS start, count(v) AS n FROM generate_series(0, 19) g(b) LEFT JOIN (SELECT least(19, floor(value / 100.0 * 20))::INT AS v FROM events WHERE value BETWEEN 0 AND 100) ON v = b GROUP BY b")
def v1(t: Tables) -> DataFrame:
    return rounded(relational.histogram(t.events, "value", 0.0, 100.0, 20), "start")
