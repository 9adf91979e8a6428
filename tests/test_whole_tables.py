"""Queries without a twin read their whole tables."""

from __future__ import annotations

import duckdb

from hyphalake.plans import registry

FOLDER = "/root/testdata/sf0.001"


def test_whole_counts(spark):
    where = FOLDER
    run = lambda name: registry.QUERIES[name](spark, where)
    n = {t: spark.read.parquet(f"{where}/{t}.parquet").count() for t in ("embeddings", "part", "supplier")}
    assert run("t19_principal_components").count() == run("t31_kmeans").count() == n["embeddings"] > 60
    assert run("g3_gains_and_losses").count() == n["part"] > 100
    wide = run("k4_wide_export_whole")
    pairs = duckdb.sql(f"SELECT count(*) FROM (SELECT DISTINCT p_brand, l_suppkey FROM '{where}/lineitem.parquet' JOIN '{where}/part.parquet' ON l_partkey = p_partkey)").fetchall()[0][0]
    assert len(wide.columns) == n["supplier"] + 1 and sum(sum(r[1:]) for r in wide.collect()) == pairs
