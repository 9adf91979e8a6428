"""The registered queries of this subpackage, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.llm import bpe, cdc, exact_dedup, html_layout, iblt, merkle, minhash, mixing, quality, secret_scan, simhash, token_align, token_store
from hyphalake.session import ship


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A tokenizer's file: in the folder that HYPHALAKE_TOKENIZERS names, or where the installation has it."""
    folder = os.environ.get("HYPHALAKE_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, _, _ = mixing.mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = token_store.training_order(_table(spark, sf_dir, "documents"))
    return slots.select("slot", "shard", "offset", "doc_id", "seq", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_report(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(_table(spark, sf_dir, "pages")).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.passage_report(_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_decode(_table(spark, sf_dir, "documents"), vocabulary())
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_report(_table(spark, sf_dir, "documents"), by_pair=True)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("row")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))[0]


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mixing, op2_token_store, op3_simhash, op4_secret_scan, op5_exact_dedup, op6_html_layout, op7_substring_dedup, op8_bpe, op9_iblt, op10_quality, op11_align, op12_minhash, op13_merkle)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS n, translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS z FROM documents),
g AS (SELECT z, arg_min(doc_id, struct_pack(a := -n, b := doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY z)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.z) AS text_sha256
FROM t JOIN g ON t.z = g.z
""",
    "op12_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS h FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS z FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.z),
m AS (SELECT doc_id, min(z) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)
""",
    "op13_merkle": r"""
WITH RECURSIVE rows_ AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, source, lang, n_chars, text,
  xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS crc FROM documents),
leaves AS (SELECT doc_id, tree, sha256({fields} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256({fields} || CASE WHEN crc % 3 = 0 THEN coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS now FROM rows_),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low AS (SELECT tree, 0 AS k, pos, n, leaf AS h FROM placed
  UNION ALL SELECT tree, k + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, k, pos // 8),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS k, pos, n, h FROM subs
  UNION ALL SELECT k + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY k, pos // 8),
nodes AS (SELECT tree, k, pos // 8 AS up, list(h ORDER BY pos) AS c FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT NULL, k, pos // 8, list(h ORDER BY pos) FROM high WHERE n > 1 GROUP BY ALL),
walk AS (SELECT doc_id, leaf, tree, 0 AS k, pos, n, '' AS sibs, now AS f FROM placed
  UNION ALL SELECT w.doc_id, w.leaf, w.tree, w.k + 1, w.pos // 8, (w.n + 7) // 8,
    w.sibs || array_to_string(c[1:w.pos % 8], '') || array_to_string(c[w.pos % 8 + 2:], ''), sha256(array_to_string(c[1:w.pos % 8], '') || w.f || array_to_string(c[w.pos % 8 + 2:], ''))
    FROM walk w JOIN nodes ON nodes.tree = w.tree AND nodes.k = w.k AND nodes.up = w.pos // 8 WHERE w.n > 1),
rise AS (SELECT w.doc_id, w.leaf, 0 AS k, s.pos, s.n, w.sibs, w.f, s.h AS subroot FROM walk w JOIN subs s ON s.tree = w.tree WHERE w.n = 1
  UNION ALL SELECT r.doc_id, r.leaf, r.k + 1, r.pos // 8, (r.n + 7) // 8,
    r.sibs || array_to_string(c[1:r.pos % 8], '') || array_to_string(c[r.pos % 8 + 2:], ''), sha256(array_to_string(c[1:r.pos % 8], '') || r.f || array_to_string(c[r.pos % 8 + 2:], '')), r.subroot
    FROM rise r JOIN nodes ON nodes.tree IS NULL AND nodes.k = r.k AND nodes.up = r.pos // 8 WHERE r.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(sibs) AS proof_sha256, f AS folded_root, f = root AS verified FROM rise, (SELECT h AS root FROM high WHERE n = 1) WHERE n = 1
""".replace("{fields}", " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))),
}
