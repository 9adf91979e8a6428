"""Reshapes and readers on the driver's tables: wide to long, nested to rows, text blocks to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyphalake.operators import relational
from hyphalake.plans.base import Tables, query


@query("s13_wide_to_long", "SELECT og, header, trim(unnest(string_split(cell, ','))) AS protein FROM (SELECT l_partkey AS og, l_returnflag AS header, string_agg(l_orderkey::VARCHAR, ', ') AS cell FROM lineitem GROUP BY 1, 2)")
def s13(t: Tables) -> DataFrame:
    wide = t.lineitem.groupBy(F.col("l_partkey").alias("og")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.array_join(F.collect_list(F.col("l_orderkey").cast("string")), ", "))
    long = wide.unpivot(["og"], ["A", "N", "R"], "header", "cell").where("cell is not null and cell <> ''")
    return long.select("og", "header", F.explode(F.transform(F.split("cell", ","), lambda x: F.trim(x))).alias("protein"))


@query("s14_gene_counts", "SELECT l_partkey AS og, l_returnflag AS genome, count(*) AS copies FROM lineitem GROUP BY 1, 2")
def s14(t: Tables) -> DataFrame:
    wide = relational.pivot_counts(t.lineitem, ["l_partkey"], "l_returnflag", ["A", "N", "R"], "Total").drop("Total")
    return wide.unpivot([F.col("l_partkey").alias("og")], ["A", "N", "R"], "genome", "copies").where("copies > 0")


@query("s1_metadata", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, round(100.0 * CAST(json_extract(props, '$.k') AS BIGINT) / 99, 6) AS pct FROM events")
def s1(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", F.from_json("props", "k bigint").alias("p"))
    return rows.select("event_id", "event_type", F.col("p.k").alias("k"), F.round(F.col("p.k") * 100.0 / 99, 6).alias("pct"))


@query("s2_accession_sets", "SELECT DISTINCT n_regionkey AS species, regexp_extract(s_name, '#(\\d+)', 1) AS accession FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def s2(t: Tables) -> DataFrame:
    rows = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("n_regionkey").alias("species"), F.regexp_extract("s_name", r"#(\d+)", 1).alias("accession")).distinct()


@query("s10_field_lines", "SELECT conv_id, turn, string_split_regex(trim(text), '[ \\t]+')[1] AS first_token, len(string_split(text, chr(10))) AS n_lines FROM conversations WHERE length(trim(text)) > 0 AND NOT regexp_matches(text, '^\\s')")
def s10(t: Tables) -> DataFrame:
    rows = t.conversations.where((F.length(F.trim("text")) > 0) & ~F.col("text").rlike(r"^\s"))
    return rows.select("conv_id", "turn", F.split(F.trim("text"), r"[ \t]+")[0].alias("first_token"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


@query("s17_alignment_sites", "SELECT p_partkey AS sample, generate_subscripts(string_split(p_name, ''), 1) - 1 AS pos, unnest(string_split(p_name, '')) AS base FROM part")
def s17(t: Tables) -> DataFrame:
    return sites(t.part)


def sites(parts: DataFrame) -> DataFrame:
    rows = parts.select(F.col("p_partkey").alias("sample"), F.posexplode(F.split("p_name", "")).alias("pos", "base"))
    return rows.where("base <> ''").withColumn("pos", F.col("pos").cast("long"))


@query("s19_text_blocks", "SELECT page_id, count(*) AS n_paragraphs FROM (SELECT page_id, unnest(string_split(html, '<p>')[2:]) AS p FROM pages) GROUP BY page_id")
def s19(t: Tables) -> DataFrame:
    blocks = t.pages.select("page_id", F.posexplode(F.split("html", "<p>")).alias("k", "block")).where("k > 0")
    return blocks.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_paragraphs"))


@query("p1_resolved_columns", "SELECT c_custkey AS id, c_name AS label, NULL::VARCHAR AS missing FROM customer")
def p1(t: Tables) -> DataFrame:
    return relational.resolve_columns(t.customer, {"id": ("C CustKey",), "label": ("title", "c-name"), "missing": ("not there",)})


@query("p10_maf_filter", "SELECT l_partkey::VARCHAR AS feature, round(least(count(DISTINCT l_suppkey) / 100.0, 1 - count(DISTINCT l_suppkey) / 100.0), 6) AS maf FROM lineitem GROUP BY l_partkey HAVING least(count(DISTINCT l_suppkey) / 100.0, 1 - count(DISTINCT l_suppkey) / 100.0) >= 0.25")
def p10(t: Tables) -> DataFrame:
    from hyphalake.operators.association import maf_filter

    rows = t.pav().select(F.col("og").cast("string").alias("feature"), F.lit(1).alias("value"))
    return maf_filter(rows, 100, least=0.25).select("feature", F.round("maf", 6).alias("maf"))


@query("p11_informative_sites", "WITH s AS (SELECT p_partkey AS sample, generate_subscripts(string_split(upper(p_name), ''), 1) - 1 AS pos, unnest(string_split(upper(p_name), '')) AS base FROM part) SELECT sample, pos, (instr('ACGT', base) - 1)::FLOAT AS code FROM s WHERE base IN ('A', 'C', 'G', 'T') AND pos IN (SELECT pos FROM s WHERE base IN ('A', 'C', 'G', 'T') GROUP BY pos HAVING count(DISTINCT base) > 1)")
def p11(t: Tables) -> DataFrame:
    from hyphalake.operators.kinship import informative_sites

    rows = t.part.select(F.col("p_partkey").alias("sample"), F.posexplode(F.split("p_name", "")).alias("pos", "base"))
    return informative_sites(rows).where("code is not null").select("sample", F.col("pos").cast("long").alias("pos"), "code")
