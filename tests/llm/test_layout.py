"""Results that do not depend on how the input is split, and scratch tables that outlive other runs."""

from __future__ import annotations

from collections import Counter

import pytest

from hyphalake.llm import mixing, queries
from hyphalake.llm.common import Scratch, noted, sweep


@pytest.fixture(scope="module")
def repeated(spark, small):
    """Documents, with one row thirty times and rows without key, of which some have one text."""
    rows = [tuple(r) for r in small.select("doc_id", "text", "source").limit(120).collect()]
    rows += [rows[3]] * 29 + [(None, rows[5][1], "s"), (None, rows[5][1], "s"), (None, rows[6][1], "s"), (None, rows[6][1], None), (rows[7][0], "other words " * 400, rows[7][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_the_mix_is_that_of_the_rows_whatever_their_order(repeated, tmp_path, spark):
    def taken(df):
        plan, _, _ = mixing.mix(df, block_tokens=64, bucket_rows=16)
        return Counter((r.doc_id, r.source, r["size"], r.taken, r.first_slot, r.last_slot) for r in plan.collect())

    want = taken(repeated)
    assert sum(want.values()) == repeated.count()
    for k, df in enumerate((repeated.repartition(7), repeated.orderBy("text").coalesce(1), repeated.repartitionByRange(3, "source"))):
        df.write.parquet(f"{tmp_path}/{k}")
        assert taken(spark.read.parquet(f"{tmp_path}/{k}")) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert taken(spark.read.parquet(f"{tmp_path}/0")) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_mixed_rows_are_the_same_whatever_their_order(repeated):
    rows = lambda df: Counter(map(tuple, mixing.mixed_documents(df, block_tokens=64, bucket_rows=16).collect()))
    assert rows(repeated) == rows(repeated.repartition(5))


def test_a_run_deletes_its_own_tables_only(spark):
    other = queries.op1_mixing(spark, "/root/testdata/sf0.001")
    with noted() as made:
        mine = Scratch(spark, "mine").keep(spark.range(5), "t")
        with noted() as inner:
            Scratch(spark, "inner").keep(spark.range(5), "t")
        assert len(made) == len(inner) == 1
    sweep(made)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(mine.inputFiles()[0]).count()
    assert other.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_a_pipeline_leaves_other_queries_alone(spark):
    import corpus_pipeline

    other = queries.op1_mixing(spark, "/root/testdata/sf0.001")
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert other.count() > 0
