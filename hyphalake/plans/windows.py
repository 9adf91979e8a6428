"""Ranks, running sums, false-discovery control, rarefaction, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.operators import convergence, isolates, pangenome, relational
from hyphalake.plans.base import Tables, query, rounded

#: A stand-in for p-values: the order line's tax and discount mapped into (0, 1].
P = "(l_tax * 100 + l_discount * 10 + (l_linenumber % 7) + 1) / 20.0"


def pvalues(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("layer"), F.expr("(l_tax * 100 + l_discount * 10 + (l_linenumber % 7) + 1) / 20.0").alias("pvalue"))


BH = """WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag AS layer, {p} AS pvalue FROM lineitem),
r AS (SELECT *, pvalue * count(*) OVER ({part}) / count(*) OVER ({part} ORDER BY pvalue RANGE UNBOUNDED PRECEDING) AS raw FROM t)
SELECT l_orderkey, l_linenumber, layer, round(pvalue, 9) AS pvalue, round(least(1.0, min(raw) OVER ({part} ORDER BY pvalue RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) AS qvalue FROM r"""


@query("w1_bh_by_layer", BH.format(p=P, part="PARTITION BY layer"))
def w1(t: Tables) -> DataFrame:
    return rounded(relational.bh_qvalues(pvalues(t), by=["layer"]), "pvalue", "qvalue", digits=9)


@query("w1_bh_global", BH.format(p=P, part=""))
def w1_global(t: Tables) -> DataFrame:
    return rounded(relational.bh_qvalues(pvalues(t)), "pvalue", "qvalue", digits=9)


@query("w2_mode", "SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day, n FROM (SELECT l_suppkey, l_shipdate, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_shipdate) AS k FROM lineitem GROUP BY l_suppkey, l_shipdate) WHERE k = 1")
def w2(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_suppkey", "l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    return relational.best_row(n, ["l_suppkey"], [F.desc("n"), F.col("l_shipdate")]).select("l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "n")


@query("w3_neighbourhood", """
WITH r AS (SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
SELECT a.user_id, b.event_id, b.event_type, (b.k - a.k)::INT AS "offset" FROM r a JOIN r b ON a.user_id = b.user_id AND b.k BETWEEN a.k - 3 AND a.k + 3 WHERE a.event_type = 'error' AND a.value > 50""")
def w3(t: Tables) -> DataFrame:
    anchor = (F.col("event_type") == "error") & (F.col("value") > 50)
    return relational.neighbours(t.events, ["user_id"], ["ts", "event_id"], 3, anchor).select("user_id", "event_id", "event_type", "offset")


@query("w4_running_sum", "SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 4) AS cum FROM orders")
def w4(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return t.orders.select("o_custkey", "o_orderkey", F.round(F.sum("o_totalprice").over(w), 4).alias("cum"))


@query("w5_outliers", "SELECT event_id, event_type, round(z, 6) AS z FROM (SELECT event_id, event_type, (value - avg(value) OVER (PARTITION BY event_type)) / stddev_samp(value) OVER (PARTITION BY event_type) AS z FROM events) WHERE abs(z) > 2")
def w5(t: Tables) -> DataFrame:
    from hyphalake.operators.burden import composition_outliers

    return rounded(composition_outliers(t.events, ["event_type"], "value"), "z").select("event_id", "event_type", "z")


@query("w6_share", "SELECT c_mktsegment, n_regionkey, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY n_regionkey), 6) AS pct FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_regionkey")
def w6(t: Tables) -> DataFrame:
    rows = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return rounded(relational.share(rows, ["c_mktsegment", "n_regionkey"], ["n_regionkey"]), "pct")


N_PERM = 200
RARE = """WITH {members}, o AS (SELECT perm::INT AS perm, genome, row_number() OVER (PARTITION BY perm ORDER BY md5('0|' || perm || '|' || genome), genome) AS pos FROM (SELECT DISTINCT genome FROM pav), generate_series(0, 199) s(perm)),
k AS (SELECT perm, og, pos, row_number() OVER (PARTITION BY perm, og ORDER BY pos) AS k FROM pav JOIN o USING (genome)),
e AS (SELECT perm, og, min(pos) AS first, coalesce(max(k) FILTER (k = pos), 0) AS unbroken FROM k GROUP BY perm, og),
g AS (SELECT perm::INT AS perm, n FROM generate_series(0, 199) p(perm), generate_series(1, (SELECT count(DISTINCT genome) FROM pav)) s(n)),
c AS (SELECT g.perm, g.n, (SELECT count(*) FROM e WHERE e.perm = g.perm AND e.first <= g.n) AS pan, (SELECT count(*) FROM e WHERE e.perm = g.perm AND e.unbroken >= g.n) AS core FROM g)"""


def curves(t: Tables) -> DataFrame:
    return pangenome.rarefaction(t.pav(), N_PERM)


@query("w7_rarefaction", f"{RARE} SELECT perm, n::INT AS n, pan, core FROM c")
def w7(t: Tables) -> DataFrame:
    return curves(t)


@query("w8_rarefaction_bands", f"{RARE} SELECT n::INT AS n, round(avg(pan), 6) AS pan_mean, round(quantile_cont(pan, 0.025), 6) AS pan_low, round(quantile_cont(pan, 0.975), 6) AS pan_high, round(avg(core), 6) AS core_mean, round(quantile_cont(core, 0.025), 6) AS core_low, round(quantile_cont(core, 0.975), 6) AS core_high FROM c GROUP BY n")
def w8(t: Tables) -> DataFrame:
    out = pangenome.rarefaction_bands(curves(t))
    return rounded(out, *[c for c in out.columns if c != "n"])


@query("t21_heaps_law", f"{RARE}, m AS (SELECT n, avg(pan) AS p FROM c GROUP BY n) SELECT round(regr_slope(ln(p), ln(n)), 6) AS gamma, round(exp(regr_intercept(ln(p), ln(n))), 4) AS kappa, CASE WHEN regr_slope(ln(p), ln(n)) > 0.8 THEN 'OPEN' WHEN regr_slope(ln(p), ln(n)) > 0.6 THEN 'MODERATELY OPEN' ELSE 'CLOSED' END AS status FROM m")
def t21(t: Tables) -> DataFrame:
    return pangenome.heaps(pangenome.rarefaction_bands(curves(t))).select(F.round("gamma", 6).alias("gamma"), F.round("kappa", 4).alias("kappa"), "status")


@query("w9_best_hit", "SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1")
def w9(t: Tables) -> DataFrame:
    return relational.best_row(t.lineitem, ["l_partkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("w11_richest_record", "SELECT conv_id, turn, length(text) AS score FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS k FROM conversations) WHERE k = 1")
def w11(t: Tables) -> DataFrame:
    rows = t.conversations.withColumn("score", F.length("text").cast("long"))
    return relational.best_row(rows, ["conv_id"], [F.desc("score"), F.col("turn")]).select("conv_id", "turn", "score")


@query("o1_reference", "SELECT s_nationkey, s_suppkey, s_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY (s_name LIKE 'GCF%' AND s_acctbal IS NOT NULL) DESC, s_acctbal DESC NULLS LAST, s_name) AS k FROM supplier) WHERE k = 1")
def o1(t: Tables) -> DataFrame:
    return isolates.references(t.supplier, ["s_nationkey"], "s_name", "s_acctbal").select("s_nationkey", "s_suppkey", "s_acctbal")


@query("o2_top_terms", "SELECT l_returnflag, l_partkey, n, rank FROM (SELECT l_returnflag, l_partkey, count(*) AS n, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_partkey)::INT AS rank FROM lineitem GROUP BY l_returnflag, l_partkey) WHERE rank <= 5")
def o2(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_returnflag", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return relational.best_row(n, ["l_returnflag"], [F.desc("n"), F.col("l_partkey")], 5, "rank")


@query("o3_top_effects", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click' ORDER BY abs(value - 50) DESC, event_id LIMIT 25")
def o3(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'click'").orderBy(F.desc(F.abs(F.col("value") - 50)), "event_id").limit(25).select("event_id", "event_type", "value")


@query("o6_longest_text", "SELECT source, doc_id, length(text) AS n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS k FROM documents) WHERE k = 1")
def o6(t: Tables) -> DataFrame:
    rows = t.documents.withColumn("n", F.length("text").cast("long"))
    return rows.groupBy("source").agg(F.max(F.struct("n", (-F.col("doc_id")).alias("d"))).alias("x")).select("source", (-F.col("x.d")).alias("doc_id"), F.col("x.n").alias("n"))


@query("o7_first_significant", "SELECT user_id, min(ts) AS first_ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events WHERE event_type = 'error' GROUP BY user_id")
def o7(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'error'").groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("u1_stack", "SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, NULL::VARCHAR AS segment, 'supplier' AS origin FROM supplier UNION ALL SELECT c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' FROM customer")
def u1(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("origin"))
    b = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("origin"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u2_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def u2(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query("u3_intersection", "SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def u3(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_nationkey").alias("k")).intersect(t.customer.where("c_acctbal < 0").select("c_nationkey"))


@query("u4_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def u4(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("u5_pending", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def u5(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.pending(t.orders, done, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("u6_private_features", "WITH {members} SELECT og FROM pav GROUP BY og HAVING bool_and(genome % 10 <> 0)")
def u6(t: Tables) -> DataFrame:
    return pangenome.private_features(t.pav(), t.supplier.where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("genome")))


@query("u8_jaccard", """WITH m AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS i FROM lineitem), s AS (SELECT g, count(*) AS n FROM m GROUP BY g)
SELECT x.g AS a, y.g AS b, count(*) AS shared, round(count(*) / (any_value(sa.n) + any_value(sb.n) - count(*)), 9) AS jaccard FROM m x JOIN m y ON x.i = y.i AND x.g < y.g JOIN s sa ON sa.g = x.g JOIN s sb ON sb.g = y.g GROUP BY x.g, y.g""")
def u8(t: Tables) -> DataFrame:
    return rounded(relational.jaccard_by_pair(t.lineitem, "l_suppkey", "l_partkey"), "jaccard", digits=9)


@query("u8_similar", """WITH m AS (SELECT DISTINCT doc_id AS g, unnest(string_split(text, ' ')) AS i FROM documents), s AS (SELECT g, count(*) AS n FROM m GROUP BY g), c AS (SELECT x.g AS a, y.g AS b, count(*) AS shared FROM m x JOIN m y ON x.i = y.i AND x.g < y.g GROUP BY 1, 2)
SELECT a, b, shared, round(shared / (p.n + q.n - shared), 9) AS jaccard FROM c JOIN s p ON p.g = a JOIN s q ON q.g = b WHERE 2 * shared >= p.n + q.n - shared""")
def u8_similar(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    return rounded(relational.jaccard_by_pair(words, "doc_id", "word", least=0.5), "jaccard", digits=9)


NULL = """a AS (SELECT perm, og FROM (SELECT perm, og, row_number() OVER (PARTITION BY perm ORDER BY md5('42a|' || perm || '|' || og), og) AS k FROM (SELECT DISTINCT l_partkey AS og FROM lineitem WHERE l_suppkey < 50), generate_series(0, 999) s(perm)) WHERE k <= 200),
b AS (SELECT perm, og FROM (SELECT perm, og, row_number() OVER (PARTITION BY perm ORDER BY md5('42b|' || perm || '|' || og), og) AS k FROM (SELECT DISTINCT l_partkey AS og FROM lineitem WHERE l_suppkey >= 50), generate_series(0, 999) s(perm)) WHERE k <= 300)"""


def backgrounds(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.lineitem.where("l_suppkey < 50").select(F.col("l_partkey").alias("og"))
    b = t.lineitem.where("l_suppkey >= 50").select(F.col("l_partkey").alias("og"))
    return a, b


@query("t26_overlap_null", f"WITH {NULL}, o AS (SELECT a.perm, count(*) AS overlap FROM a JOIN b ON a.perm = b.perm AND a.og = b.og GROUP BY a.perm) SELECT s.perm::INT AS perm, coalesce(overlap, 0) AS overlap FROM generate_series(0, 999) s(perm) LEFT JOIN o ON o.perm = s.perm")
def t26(t: Tables) -> DataFrame:
    return convergence.overlap_null(*backgrounds(t), 200, 300, 1000)


@query("t26_null_summary", f"WITH {NULL}, o AS (SELECT a.perm, count(*) AS overlap FROM a JOIN b ON a.perm = b.perm AND a.og = b.og GROUP BY a.perm), f AS (SELECT coalesce(overlap, 0) AS v FROM generate_series(0, 999) s(perm) LEFT JOIN o ON o.perm = s.perm) SELECT 32 AS observed, round(avg(v), 6) AS null_mean, round(stddev_samp(v), 6) AS null_sd, round(count(*) FILTER (v >= 32) / count(*), 6) AS p_empirical, round((count(*) FILTER (v >= 32) + 1) / (count(*) + 1), 6) AS p_corrected FROM f")
def t26_summary(t: Tables) -> DataFrame:
    out = convergence.null_summary(convergence.overlap_null(*backgrounds(t), 200, 300, 1000), 32)
    return rounded(out, "null_mean", "null_sd", "p_empirical", "p_corrected")


@query("t27_term_jaccard_null", f"""WITH {NULL}, t AS (SELECT p_partkey AS og, 'name' AS layer, unnest(string_split(p_name, ' ')) AS term FROM part UNION ALL SELECT p_partkey, 'brand', p_brand FROM part),
x AS (SELECT DISTINCT perm, layer, term FROM a JOIN t USING (og)), y AS (SELECT DISTINCT perm, layer, term FROM b JOIN t USING (og))
SELECT perm::INT AS perm, layer, round(count(*) FILTER (x.term IS NOT NULL AND y.term IS NOT NULL) / count(*), 9) AS jaccard FROM x FULL JOIN y USING (perm, layer, term) GROUP BY perm, layer""")
def t27(t: Tables) -> DataFrame:
    a, b = backgrounds(t)
    terms = t.part.select(F.col("p_partkey").alias("og"), F.lit("name").alias("layer"), F.explode(F.split("p_name", " ")).alias("term")).unionByName(t.part.select(F.col("p_partkey").alias("og"), F.lit("brand").alias("layer"), F.col("p_brand").alias("term")))
    out = convergence.term_jaccard_null(terms, convergence.random_sets(a, 200, 1000, "42a"), convergence.random_sets(b, 300, 1000, "42b"))
    return rounded(out, "jaccard", digits=9)
