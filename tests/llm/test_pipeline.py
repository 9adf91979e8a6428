"""The pipeline's stages on the small table, each against what its operator says."""

from __future__ import annotations

import re

from hyphalake.llm import exact_dedup, mixing, quality, simhash


def test_stages_keep_the_columns_and_take_effect(spark, small):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == small.columns
        before, after = docs.count(), out.count()
        if name == "quality":
            bad = quality.score_documents(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("not keep").count()
            assert after == before - bad
        elif name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.collect()]
            assert len(texts) == len(set(texts)) == exact_dedup.exact_dedup(docs).select("text_sha256").distinct().count()
        elif name == "near_dedup":
            assert after == simhash.near_groups(docs).select("component_id").distinct().count()
        elif name == "mixing":
            plan = {r.doc_id: (r.taken, r.size) for r in mixing.mix(docs)[0].collect()}
            for r in out.groupBy("doc_id").count().collect():
                taken, size = plan[r.doc_id]
                assert r["count"] == (2 * taken + size) // (2 * size)
        docs = spark.createDataFrame(out.collect(), small.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count() and {"doc_id", "n_tokens", "ids"} <= set(last.columns)
    assert corpus_pipeline.run(spark, folder).count() > 0
