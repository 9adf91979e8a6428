"""Exact deduplication against a persistent digest index, bucketed and sorted by hash.

The index is a parquet table with one row a distinct text: its digest, the key of the row that stays
and that row's length, and the batch that brought it.  It is bucketed and sorted by digest, so new data meets it in a sort-merge
anti-join that shuffles the new digests only; what the join lets through is appended.

Scale: a text is read once and never shuffled, only (digest, key, length) is.  Groups of copies are
pre-aggregated before the shuffle, so a digest with a third of all rows sends one row a task.  The
verdict on each row is a join of the rows with one row a digest, both kept in tables, a sort-merge join
that adaptive execution splits where a digest is hot.

Recovery: the index is appended to in one committed job and remembers which batch brought a text, so a
run that fails after that is simply run again.  The number of buckets lies beside the index; opening it
with another one fails.

Defined cases: null text counts as empty; texts are equal when identical after deleting every
character of [\\x20\\x09-\\x0D]; a null key ranks after all others of its length; rows that repeat a
key are all reported, alike, and without_copies() lets one of them stay; an empty batch changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hyphalake.llm.common import BLANKS, Scratch, shared_dir, shuffle_partitions, there

SCHEMA = "digest binary, keep_id long, n_chars long, batch string"


def normal_digest(text: Column) -> Column:
    """SHA-256 of the text without white space, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), normal_digest(F.col(text)).alias("digest"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"))


def keepers(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n_chars, group_size): of equal texts the longest row stays, then the smallest key."""
    best = F.max(F.struct("n_chars", F.coalesce(-F.col("doc_id"), F.lit(-(2**63) + 1)).alias("rank"), "doc_id")).alias("best")
    return rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size")).select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.n_chars").alias("n_chars"), "group_size")


class DigestIndex:
    """The persistent index at a shared path; opened again by the path, which holds the number of buckets too."""

    def __init__(self, spark: SparkSession, path: str | None = None, n_buckets: int | None = None):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/digest-index-{uuid.uuid4().hex}"
        meta = f"{self.path.rstrip('/')}-buckets"
        held = spark.read.schema("n int").parquet(meta).first()["n"] if there(spark, f"{meta}/_SUCCESS") else None
        if held is not None and n_buckets not in (None, held):
            raise ValueError(f"the index at {self.path} has {held} buckets, not {n_buckets}")
        self.n_buckets = held or n_buckets or shuffle_partitions(spark)
        if held is None:
            spark.createDataFrame([(self.n_buckets,)], "n int").coalesce(1).write.mode("overwrite").parquet(meta)
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:40]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.n_buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index lacks: sort-merge anti-join, only groups are shuffled."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        rows = groups.select("digest", "keep_id", "n_chars", F.lit(batch).alias("batch"))
        rows.write.mode("append").format("parquet").bucketBy(self.n_buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)

    def ingest(self, rows: DataFrame, batch: str | None = None) -> str:
        """Adds the new texts among rows (doc_id, digest, n_chars) and returns the batch's name.

        Without a name a batch is named by what it holds, so the same batch offered again finds its own rows.
        """
        if batch is None:
            seen = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.xxhash64(F.lit(k), "doc_id", "digest", "n_chars").cast("decimal(38,0)")).alias(f"h{k}") for k in range(2)]).first()
            batch = f"{seen.n}-{seen.h0}-{seen.h1}"
        self.append(self.unseen(keepers(rows)), batch)
        return batch

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """One row a row of docs: doc_id, keep_id, group_size (in this batch), kept, text_sha256, is_new.

    A row whose text an earlier batch of the index holds is not kept; its keep_id is that batch's row.  A
    batch that is offered again, as after a failure, gets the verdicts it got before.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark)
    scratch = Scratch(spark, "exact-dedup")
    rows = scratch.keep(digests(docs, key, text), "digests")
    batch = index.ingest(rows, batch)
    sizes = keepers(rows).select("digest", "group_size")
    # Kept in a table, so that the join below has plain shuffles on both sides and a hot digest's rows are split.
    known = scratch.keep(index.read().select("digest", "keep_id", (F.col("batch") == batch).alias("is_new")).join(sizes, "digest"), "known")
    out = rows.join(known, "digest")
    kept = F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "is_new")


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, in the columns of docs: one of equal texts, also where rows repeat a key."""
    verdict = exact_dedup(docs, key=key, text=text).where("kept").select(F.col("doc_id").alias("_keep_id"), F.unhex("text_sha256").alias("_keep_digest"))
    marked = docs.withColumn("_digest", normal_digest(F.col(text)))
    out = [marked[c] for c in docs.columns]

    def staying(kept: DataFrame) -> DataFrame:
        same = marked[key].cast("long").eqNullSafe(F.col("_keep_id")) & (marked["_digest"] == F.col("_keep_digest"))
        return marked.join(kept, same, "left_semi")

    counted = verdict.groupBy("_keep_id", "_keep_digest").agg(F.count(F.lit(1)).alias("n"))
    if not counted.where("n > 1").head(1):
        return staying(verdict).select(out)
    # Rows that repeat the key that stays: the longest of each, found among those rows alone.
    best = Window.partitionBy(F.col(key), "_digest").orderBy(F.length(text).desc())
    many = staying(counted.where("n > 1")).withColumn("_n", F.row_number().over(best)).where("_n = 1")
    return staying(counted.where("n = 1")).select(out).unionByName(many.select(*[F.col(f"`{c}`") for c in docs.columns]))
