"""Readers, sinks, relational operators and streaming on small files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hyphalake.operators import enrichment, isolates, pangenome, relational
from hyphalake.sources import readers, store
from hyphalake.streaming import events


@pytest.fixture
def folder(tmp_path):
    def put(name, body):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
        return str(p)

    return put


def test_orthogroups(spark, folder):
    p = folder("Orthogroups.tsv", "Orthogroup\tGCA_000000001.1_X.proteins\tGCA_000000002.1_Y.proteins\tGCF_000000003.1_Z.proteins\nOG1\tF1-T1, F2-T1\tF9-T1\tF1-T1\nOG2\t\tF4-T1\t\nOG3\tF7-T1\t\tF3-T1, \n")
    long = readers.orthogroups(spark, p)
    assert {r.og: r["count"] for r in long.groupBy("og").count().collect()} == {"OG1": 4, "OG2": 1, "OG3": 2}
    pav = pangenome.presence(long, "og", "accession")
    assert {r.og: r.n_genomes for r in pangenome.frequency(pav).collect()} == {"OG1": 3, "OG2": 1, "OG3": 2}
    assert sorted(r.copies for r in pangenome.copy_number(long, "og", "accession").where("og = 'OG1'").collect()) == [1, 1, 2]
    q = folder("c.tsv", "Orthogroup\tniger__GCA_000000001.1\tflavus_ani_filtered__GCF_000000003.1\tTotal\nN0\t2\t0\t2\n")
    assert [tuple(r) for r in readers.gene_counts(spark, q).collect()] == [("N0", "niger", "GCA_000000001.1", 2)]


def test_annotation_readers(spark, folder):
    e = folder("GCA_000000001.1/e.tsv", "## made by\n#query\tGOs\tCOG_category\tPFAMs\np1\tGO:1\tK\tPF1\n## done\n")
    r = readers.emapper(spark, e).first()
    assert (r["query"], r.GOs, r.EC, r.accession) == ("p1", "GO:1", "", "GCA_000000001.1")
    with pytest.raises(ValueError):
        readers.emapper(spark, folder("bad.tsv", "## 0 queries scanned\n"))
    d = folder("d.tsv", "Gene ID\tEC#\tdbCAN_hmm\tdbCAN_sub\tDIAMOND\t#ofTools\tRecommend Results\tSubstrate\np1\t-\tGH5(1-9)+CBM1\t-\tGH5\t2\t-\txylan\np2\t-\tGH1\t-\t-\t3\tAA9\t-\n")
    assert {r.Protein_ID: r.CAZy for r in readers.dbcan(spark, d).collect()} == {"p1": "GH5, CBM1", "p2": "AA9"}
    i = folder("i.tsv", "p1\tm\t9\tPfam\tPF2\td\t1\t2\t-\tT\t-\tIPR2\tx\tGO:2\t-\np1\tm\t9\tSMART\tSM1\td\t1\t2\t-\tT\t-\tIPR1\ty\tGO:2\tKEGG: 1.1.1.1\np1\tm\t9\tPfam\tPF1\td\t1\t2\t-\tT\t-\t-\t-\t-\t-\n")
    r = readers.interproscan(spark, i).first()
    assert (r.IPR, r.GO, r.PFAM, r.EC) == ("IPR2, IPR1", "GO:2", "PF2, PF1", "1.1.1.1")
    s = folder("s.txt", "# x\np1 extra\tSP(Sec/SPI)\t0.1\t0.9\tCS\nshort\n")
    assert [(r.Protein_ID, r.secreted) for r in readers.signalp(spark, s).collect()] == [("p1", True)]


def test_sequence_readers(spark, folder):
    f = folder("GCA_000000001.1.fa", ">s1_genomic.fa x\nACG\nT\n>s2.fa\nAC-N\n")
    assert [(r.id, r.sequence) for r in readers.fasta(spark, f).orderBy("id").collect()] == [("s1_genomic.fa", "ACGT"), ("s2.fa", "AC-N")]
    sites = readers.snp_alignment(spark, f)
    assert sites.count() == 8 and {r["sample"] for r in sites.collect()} == {"s1", "s2"}
    g = folder("GCA_000000002.1.gff3", "##gff\nc1\tx\tgene\t5\t90\t.\t+\t.\tID=g1;Name=n\nc1\tx\tmRNA\t5\t90\t.\t+\t.\tID=m1\n")
    assert [(r.gene, r.start, r.accession) for r in readers.gff_genes(spark, g).collect()] == [("g1", 5, "GCA_000000002.1")]


def test_cluster_readers(spark, folder):
    body = {"records": [{"id": "sc1", "areas": [{"start": 100, "end": 200, "products": ["NRPS"]}], "features": [{"type": "CDS", "location": "[50:100](+)", "qualifiers": {"locus_tag": ["a"]}}, {"type": "CDS", "location": "join{[201:210](-), [230:240](-)}", "qualifiers": {"gene": ["b"], "protein_id": ["c"]}}, {"type": "gene", "location": "[1:2]", "qualifiers": {}}]}]}
    areas, genes = readers.antismash(spark, folder("GCA_000000001.1.json", json.dumps(body)))
    assert genes.count() == 2
    hit = relational.interval_overlap(areas, genes, ["accession", "scaffold"]).collect()
    assert [r.names_r for r in hit] == [["a"]]
    k = folder("k.txt", "intro\n>>\n1. BGC0001\nSource: gliotoxin\nNumber of proteins with BLAST hits to this cluster: 5\nCumulative BLAST score: 77.5\n>>\n2. BGC0002\nSource: x\n")
    assert [(r["rank"], r.ref_id, r.compound, r.score) for r in readers.known_clusters(spark, k).orderBy("rank").collect()] == [(1, "BGC0001", "gliotoxin", 77.5), (2, "BGC0002", "x", 0.0)]
    b = folder("run_1/c.tsv", "Record\tGBK\tFamily\nGCA_000000001.1_sc1.region001\tg\tFAM1\nBGC0001\tg\tFAM1\n")
    assert {r.strain: (r.run, r.is_reference) for r in readers.bigscape(spark, b).collect()} == {"GCA_000000001.1": ("run_1", False), "BGC0001": ("run_1", True)}


def test_metadata_readers(spark, folder):
    j = folder("m.jsonl", json.dumps({"accession": "GCA_1.1", "organism": {"infraspecific_names": {"strain": "s"}}, "assembly_stats": {"number_of_contigs": 9, "total_sequence_length": "100"}, "assembly_info": {"biosample": {"attributes": [{"name": "host", "value": "h"}, {"name": "lat_lon", "value": "1 N 2 E"}]}}}) + "\n")
    r = readers.assembly_reports(spark, j).first()
    assert (r.strain, r.contigs, r.size, r.host, r.lat_lon, r.isolation_source) == ("s", 9, 100, "h", "1 N 2 E", None)
    b = readers.busco_summary(spark, folder("GCA_000000001.1.txt", "C:90%\n 3600 Complete BUSCOs (C)\n 3800 Total BUSCO groups searched\n")).first()
    assert b.percent == pytest.approx(94.7368, abs=1e-4)
    p = folder("fumigatus_virulence_panel.csv", "gene,category\nA,x\n")
    assert [(r.gene, r.species, r.panel) for r in readers.panels(spark, [p]).collect()] == [("A", "fumigatus", "virulence")]
    c = readers.geocode_cache(spark, folder("g.json", '{"Japan": [1.0, 2.0]}')).first()
    assert tuple(c) == ("Japan", 1.0, 2.0)
    m = readers.manual_places(spark, folder("p.txt", "Location: Tokyo\nLat: 35.5\nLon: 139\n\nLocation: nowhere\n")).collect()
    assert [tuple(x) for x in m] == [("Tokyo", 35.5, 139.0)]


def test_store(spark, tmp_path):
    path, calls = f"file://{tmp_path}/t", []
    build = lambda: calls.append(1) or spark.range(3)
    assert store.cached(spark, path, build).count() == store.cached(spark, path, build).count() == 3 and len(calls) == 1
    done = f"file://{tmp_path}/d"
    todo = spark.range(5).withColumnRenamed("id", "k")
    assert store.append_missing(todo.where("k < 2"), done, ["k"], lambda d: d) == 2
    assert store.append_missing(todo, done, ["k"], lambda d: d) == 3 and store.append_missing(todo, done, ["k"], lambda d: d) == 0
    store.write_partitioned(todo.withColumn("p", F.col("k") % 2), f"file://{tmp_path}/p", ["p"])
    assert spark.read.parquet(f"file://{tmp_path}/p").where("p = 1").count() == 2
    assert [r.present for r in store.preflight(spark, {"a": path, "b": path + "x"}).orderBy("name").collect()] == [True, False]


@pytest.mark.parametrize("p, q", [([0.01, 0.02, 0.03, 0.04], [0.04] * 4), ([0.01, 0.04, 0.03], [0.03, 0.04, 0.04]), ([0.5, None, 0.5], [0.5, None, 0.5])])
def test_step_up_q(spark, p, q):
    df = spark.createDataFrame(list(enumerate(p)), "i int, pvalue double")
    got = [r.qvalue for r in relational.bh_qvalues(df).orderBy("i").collect()]
    assert got == [pytest.approx(x) if x is not None else None for x in q]


def test_consensus_ties(spark):
    df = spark.createDataFrame([("o", "a,b"), ("o", "a"), ("o", "c"), ("p", "b"), ("p", "a"), ("q", "-")], "og string, t string")
    got = {r.og: (r.term, r.is_majority) for r in pangenome.consensus(df, ["og"], ["t"]).collect()}
    assert got == {"o": ("a", True), "p": ("a", True)}


def test_quality_cuts(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 11)] + [(2, None)], "contigs int, n50 int")
    r = isolates.quality_cuts(df).first()
    assert r.n50_p75 == 7 and r.contigs_median == 5


def test_binned_overlap_equals_plain(spark):
    a = spark.range(200).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 500).alias("start"), (F.col("id") * 7 % 500 + F.col("id") % 60).alias("end"))
    plain = relational.interval_overlap(a, a, ["k"])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, relational.interval_overlap(a, a, ["k"], bin_size=16).collect()))


def test_enrichment_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([(i, "Core" if i % 2 else "Rare", "x;y" if i % 3 else "z") for i in range(60)], "og int, pangenome_class string, t string")
    out = enrichment.class_enrichment(df, ["t"])
    assert out.count() == 3 and "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


def test_streams(spark, tmp_path):
    folder = f"file://{tmp_path}/events"
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch.repartition(3).write.parquet(folder)
    s = events.event_stream(spark, folder, batch.schema)
    q = events.windowed_counts(s).writeStream.outputMode("complete").format("memory").queryName("hourly").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("hourly").agg(F.sum("n")).first()[0] == batch.count()


def test_headers_are_read_file_by_file(spark, folder):
    """Two files whose columns stand in another order, and matrices with other genomes."""
    a, b = folder("GCA_000000001.1.annotations", "#query\tGOs\tPFAMs\nq1\tGO:1\tPF1\n"), folder("GCA_000000002.1.annotations", "## x\n#query\tPFAMs\tCOG_category\tGOs\nq2\tPF2\tK\tGO:2\n")
    got = {r["query"]: (r.GOs, r.PFAMs, r.COG_category) for r in readers.emapper(spark, [a, b]).collect()}
    assert got == {"q1": ("GO:1", "PF1", ""), "q2": ("GO:2", "PF2", "K")}
    x = folder("x.tsv", "Orthogroup\tGCA_000000001.1_a\tGCA_000000002.1_b\nN0\tp1\tp2, p3\n")
    y = folder("y.tsv", "Orthogroup\tGCA_000000003.1_c\nN0\tp4\n")
    assert sorted((r.og, r.accession, r.protein) for r in readers.orthogroups(spark, [x, y]).collect()) == [("N0", "GCA_000000001.1", "p1"), ("N0", "GCA_000000002.1", "p2"), ("N0", "GCA_000000002.1", "p3"), ("N0", "GCA_000000003.1", "p4")]


def test_fasta_headers_may_hold_the_mark(spark, folder):
    f = folder("marks.fa", ">p1 A->B x\nACGT\nAC\n>p2\r\nGG\r\n>p3 a > b\nT\n")
    assert {r.id: r.sequence for r in readers.fasta(spark, f).collect()} == {"p1": "ACGTAC", "p2": "GG", "p3": "T"}


def test_kept_tables_are_forgotten(spark):
    from hyphalake.sources import shared

    shared.forget(spark)
    df = shared.kept(spark.range(3), "numbers")
    assert df.count() == 3 and shared.forget(spark) == 1 and shared.forget(spark) == 0
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_a_cache_is_built_again_when_its_inputs_or_parameters_change(spark, tmp_path):
    root, calls = f"file://{tmp_path}", []
    spark.range(3).write.parquet(f"{root}/in")

    def read(n=1, **more):
        return store.cached(spark, f"{root}/out", lambda: calls.append(n) or spark.read.parquet(f"{root}/in").withColumn("n", F.lit(n)), inputs=[f"{root}/in", f"{root}/none"], parameters={"n": n}, **more)

    assert read().count() == read().count() == 3 and len(calls) == 1
    spark.range(5).write.mode("overwrite").parquet(f"{root}/in")
    assert read().count() == 5 and len(calls) == 2
    assert read(2).first().n == 2 and len(calls) == 3
    assert read(2, force=True).count() == 5 and len(calls) == 4
