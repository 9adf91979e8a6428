"""Isolate metadata: quality control, references, deduplication of accessions, coordinates, panels and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.functions.rules import kingdom
from hyphalake.functions.text import location_key, parse_lat_lon, present
from hyphalake.operators.burden import hit_class
from hyphalake.operators.relational import best_row


def quality_cuts(rows: DataFrame, contigs: str = "contigs", n50: str = "n50") -> DataFrame:
    """One row: median contigs, cut to a whole number, and the nearest-rank upper quartile of N50.

    The quartile is the value at place int(0.75 n) (at least 1) in ascending order, not interpolated; it is
    found by rank counts, so no list of values is made.
    """
    n = rows.where(F.col(n50).isNotNull()).groupBy(F.col(n50).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    up = n.withColumn("upto", F.sum("c").over(Window.orderBy("v"))).withColumn("total", F.sum("c").over(Window.partitionBy()))
    p75 = up.where(F.col("upto") >= F.greatest(F.lit(1), F.floor(F.col("total") * 0.75))).agg(F.min("v").alias("n50_p75"))
    return rows.agg(F.floor(F.median(contigs)).cast("long").alias("contigs_median")).crossJoin(p75)


def passing(rows: DataFrame, cuts: DataFrame, busco_cut: float, contigs: str = "contigs", n50: str = "n50", busco: str = "busco") -> DataFrame:
    """Rows on the right side of every cut; cuts is one row."""
    both = rows.join(F.broadcast(cuts))
    return both.where((F.col(contigs) <= F.col("contigs_median")) & (F.col(n50) >= F.col("n50_p75")) & (F.col(busco) > busco_cut)).select(*rows.columns)


def identity_check(rows: DataFrame, ani: DataFrame, key: str = "accession", threshold: float = 95.0) -> DataFrame:
    """rows with ani and whether it reaches the threshold; no value counts as a failure."""
    return rows.join(ani.select(key, "ani"), key, "left").withColumn("same_species", F.coalesce("ani", F.lit(-1.0)) >= threshold)


def excluded_rows_out(rows: DataFrame, excluded: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows none of whose labels contains an excluded accession."""
    out = rows
    for c in columns:
        for e in excluded:
            out = out.where(~F.coalesce(F.contains(F.col(c), F.lit(e)), F.lit(False)))
    return out


def references(rows: DataFrame, by: Sequence[str], key: str, score: str) -> DataFrame:
    """The reference of each group: the best score among RefSeq accessions, else among all."""
    refseq = F.col(key).startswith("GCF") & F.col(score).isNotNull()
    return best_row(rows, by, [F.desc(refseq), F.desc_nulls_last(score), F.col(key)])


def without_mirrors(genbank: DataFrame, refseq: DataFrame, key: str = "accession") -> DataFrame:
    """GenBank rows whose assembly number RefSeq lacks."""
    number = F.regexp_extract(key, r"GC[AF]_(\d+)", 1)
    return genbank.withColumn("_n", number).join(refseq.select(number.alias("_n")).distinct(), "_n", "left_anti").drop("_n")


def qc_summary(rows: DataFrame, by: Sequence[str], flag: str, value: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("n_pass"), (100.0 * F.count_if(flag) / F.count(F.lit(1))).alias("pct_pass"), F.median(value).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"))


def coordinates(rows: DataFrame, manual: DataFrame, geocoded: DataFrame, key: str = "strain", location: str = "location", latlon: str = "lat_lon") -> DataFrame:
    """rows with lat, lon and where they come from: own text, list by strain, list by place, part of a name, geocode.

    manual: (name, lat, lon), whose names may be strains or places and which is a short list by hand.
    """
    own = rows.withColumn("_own", parse_lat_lon(F.col(latlon))).withColumn("_place", location_key(F.lower(F.col(location))))
    m = F.broadcast(manual.select(location_key(F.lower(F.col("name"))).alias("_name"), F.struct("lat", "lon").alias("_at")).dropDuplicates(["_name"]))
    by_strain = m.select(F.col("_name").alias("_s"), F.col("_at").alias("_strain_at"))
    by_place = m.select(F.col("_name").alias("_p"), F.col("_at").alias("_place_at"))
    out = own.join(by_strain, F.lower(F.col(key)) == F.col("_s"), "left").join(by_place, F.col("_place") == F.col("_p"), "left")
    names = m.agg(F.array_sort(F.collect_list(F.struct("_name", "_at"))).alias("_names"))
    out = out.join(F.broadcast(names))
    part = F.filter("_names", lambda x: F.contains(F.col("_place"), x["_name"]) | ((F.col("_place") != "") & F.contains(x["_name"], F.col("_place"))))
    out = out.withColumn("_part_at", F.get(part, F.lit(0))["_at"])
    g = geocoded.select(location_key(F.lower(F.col("name"))).alias("_g"), F.struct("lat", "lon").alias("_geo_at")).dropDuplicates(["_g"])
    out = out.join(g, F.col("_place") == F.col("_g"), "left")
    at = F.coalesce("_own", "_strain_at", "_place_at", "_part_at", "_geo_at")
    told = F.when(F.col("_own").isNotNull(), "lat_lon").when(F.coalesce("_strain_at", "_place_at", "_part_at").isNotNull(), "manual").when(F.col("_geo_at").isNotNull(), "geocode")
    return out.select(*[rows[c] for c in rows.columns], at["lat"].alias("lat"), at["lon"].alias("lon"), told.alias("coordinate_source"))


def cache_reconcile(wanted: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """(key, state): which keys a cache has, lacks, or should not have."""
    w, c = wanted.select(key).distinct().withColumn("_w", F.lit(1)), cached.select(key).distinct().withColumn("_c", F.lit(1))
    state = F.when(F.col("_c").isNull(), "missing").when(F.col("_w").isNull(), "extra").otherwise("cached")
    return w.join(c, key, "full_outer").select(key, state.alias("state"))


def recheck(failed: DataFrame, sisters: DataFrame, threshold: float = 95.0, key: str = "accession") -> DataFrame:
    """For rows that failed the identity check, their closest sister species and whether it is a match."""
    top = best_row(sisters.join(failed.select(key), key, "left_semi"), [key], [F.desc("ani"), F.col("reference")])
    return failed.select(key).join(top.select(key, "reference", F.col("ani").alias("sister_ani")), key, "left").withColumn("is_match", F.coalesce(F.col("sister_ani") >= threshold, F.lit(False)))


def foreign_hits(hits: DataFrame, cutoff: float = 1e-5, by: Sequence[str] = ("species",), feature: str = "og") -> DataFrame:
    """The best hit of each feature with the kingdom of its organism; weak hits are of no kingdom."""
    top = best_row(hits, [*by, feature], [F.col("evalue"), F.desc("pident"), F.col("organism")])
    strong = F.col("evalue") <= cutoff
    return top.withColumn("kingdom", F.when(strong, kingdom(F.col("organism"))).otherwise("No confident hit")).withColumn("is_foreign", strong & ~F.col("kingdom").isin("Aspergillus (self)", "Other fungi", "Unknown"))


def aligned_classes(features: DataFrame, hits: DataFrame, feature: str = "og") -> DataFrame:
    """Every feature with the class of its best alignment; those without one have none."""
    top = best_row(hits, [feature], [F.desc("bitscore"), F.col("evalue"), F.col("sseqid")])
    kind = hit_class(F.col("qcov"), F.col("scov"), F.col("pident"))
    return features.join(top.select(feature, "sseqid", kind.alias("_class")), feature, "left").withColumn("hit_class", F.coalesce("_class", F.lit("No hit"))).drop("_class")


def reading_frames(genes: DataFrame, lengths: DataFrame, by: Sequence[str], edge: int = 100) -> DataFrame:
    """Complete reading frames and genes near a contig's end, in per cent, by group.

    genes: (by, contig, start, end, starts, stops, in_frame); lengths: (contig, length).
    """
    near = (F.col("start") <= edge) | (F.col("length") - F.col("end") <= edge)
    whole = F.col("starts") & F.col("stops") & F.col("in_frame")
    joined = genes.join(lengths, "contig", "left")
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (100 * F.avg(whole.cast("int"))).alias("pct_complete"), (100 * F.avg(F.coalesce(near, F.lit(False)).cast("int"))).alias("pct_edge"))


# -- panels ------------------------------------------------------------------------------------------


def best_alignments(hits: DataFrame, query: str = "qseqid", by: Sequence[str] = ()) -> DataFrame:
    """The hit with the highest bit score of each query, with its coverage of the query in per cent."""
    top = best_row(hits, [*by, query], [F.desc("bitscore"), F.col("evalue"), F.col("sseqid")])
    return top.withColumn("qcov", F.lit(100.0) * F.col("length") / F.col("qlen"))


def anchor_panel(panel: DataFrame, hits: DataFrame, members: DataFrame, classes: DataFrame, species: Sequence[str]) -> DataFrame:
    """Panel genes on features: best hit, the feature of its subject, and the feature's class in every species."""
    top = best_alignments(hits, by=["species"]).select("species", F.col("qseqid").alias("gene"), "sseqid", "pident", "qcov")
    on = top.join(members.select(F.col("protein").alias("sseqid"), "og"), "sseqid", "left")
    wide = classes.groupBy("og").pivot("species", list(species)).agg(F.first("class"))
    wide = wide.select("og", *[F.col(s).alias(f"class_{s}") for s in species])
    native = F.coalesce(*[F.when(F.col("species") == s, F.col(f"class_{s}")) for s in species])
    return on.join(panel, ["species", "gene"], "left").join(wide, "og", "left").withColumn("native_class", native)


def validated_panel(anchored: DataFrame, valid: DataFrame, audited_out: DataFrame) -> DataFrame:
    """Anchored genes on the valid list (gene and species, without case) and not on the audit's list."""
    k = lambda df: df.select(F.lower("gene").alias("_g"), F.lower("species").alias("_s")).distinct()
    on = (F.lower(anchored["gene"]) == F.col("_g")) & (F.lower(anchored["species"]) == F.col("_s"))
    return anchored.join(k(valid), on, "left_semi").join(k(audited_out), on, "left_anti")


def conservation(panel: DataFrame, species: Sequence[str]) -> DataFrame:
    """panel with the number of species in which the feature is core, and in which it is present."""
    core, there = F.lit(0), F.lit(0)
    for s in species:
        core = core + F.coalesce((F.col(f"class_{s}") == "Core").cast("int"), F.lit(0))
        there = there + F.coalesce((F.col(f"class_{s}") != "Absent").cast("int"), F.lit(0))
    return panel.withColumn("n_core", core).withColumn("n_present", there)


# -- gene clusters -----------------------------------------------------------------------------------


def family_rollup(records: DataFrame, hits: DataFrame, family: str = "family", max_hits: int = 3, min_support: float = 0.5) -> DataFrame:
    """One row a family: regions, strains, modal class and its purity, categories, reference members, ranked known hits.

    records: family, record, strain, class, category, is_reference.  hits: family, record, ref_id, compound,
    score.  Known hits rank by number of regions, then by best score; support is the top hit's share of regions.
    """
    # Rows that agree in everything meet once; the figures below are made from these.
    every = records.groupBy(family, "is_reference", "record", "strain", "class", "category").agg(F.count(F.lit(1)).alias("n"))
    own = every.where(~F.col("is_reference"))
    base = own.groupBy(family).agg(F.countDistinct("record").alias("n_regions"), F.countDistinct("strain").alias("n_strains"), F.array_join(F.array_sort(F.collect_set("category")), "; ").alias("categories"))
    refs = every.where("is_reference").groupBy(family).agg(F.array_join(F.array_sort(F.collect_set("record")), "; ").alias("references"))
    kinds = own.where(present(F.col("class")).isNotNull()).groupBy(family, "class").agg(F.sum("n").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("class").alias("c"))).alias("first")
    modal = kinds.groupBy(family).agg(first, F.sum("n").alias("all")).select(family, F.col("first.c").alias("modal_class"), (-F.col("first.n") / F.col("all")).alias("purity"))
    known = hits.groupBy(family, "ref_id", "compound").agg(F.countDistinct("record").alias("n"), F.max("score").alias("score"))
    ranked = best_row(known, [family], [F.desc("n"), F.desc("score"), F.col("ref_id")], max_hits, "rank")
    listed = ranked.groupBy(family).agg(F.max(F.when(F.col("rank") == 1, F.col("ref_id"))).alias("top_id"), F.max(F.when(F.col("rank") == 1, F.col("compound"))).alias("top_compound"), F.max(F.when(F.col("rank") == 1, F.col("n"))).alias("_top"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ref_id"))), lambda x: x["ref_id"]), "; ").alias("known_hits"))
    out = base.join(refs, family, "left").join(modal, family, "left").join(listed, family, "left")
    support = F.col("_top") / F.col("n_regions")
    return out.withColumn("support", support).withColumn("confident", F.coalesce(support >= min_support, F.lit(False))).drop("_top")
