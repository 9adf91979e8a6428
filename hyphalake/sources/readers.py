"""Readers of annotation, cluster, sequence and metadata files; every one takes paths or globs and stays lazy.

Files are read by Spark's own sources, so they may lie in any store, and a file's tag (accession or
species) comes from its path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.functions.text import accession, before_scaffold, cazy_families, combine_annotations, ec_numbers, first_match, species_label, unique_join
from hyphalake.operators.relational import resolve_columns

# Columns and headers of the file formats.
EMAPPER = ("query", "Description", "COG_category", "GOs", "EC", "KEGG_ko", "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE", "KEGG_TC", "CAZy", "BiGG_Reaction", "PFAMs")
EMAPPER_ALIASES = {"query": ("#query", "query_name", "#query_name"), "Description": ("eggNOG free text desc.", "eggnog_description"), "GOs": ("GO_terms",), "COG_category": ("COG cat", "COG Functional cat."), "PFAMs": ("Pfams",)}
INTERPRO = "Protein_ID string, MD5 string, Length int, Analysis string, Signature_Acc string, Signature_Desc string, Start int, Stop int, Score string, Status string, Date string, IPR_Acc string, IPR_Desc string, GO string, Pathways string"
DBCAN_ALIASES = {"Protein_ID": ("Gene ID",), "ec": ("EC#",), "hmm": ("dbCAN_hmm", "HMMER"), "sub": ("dbCAN_sub",), "diamond": ("DIAMOND",), "n_tools": ("#ofTools",), "recommended": ("Recommend Results",), "substrate": ("Substrate",)}
OUTFMT6 = "qseqid string, sseqid string, pident double, length int, qlen int, slen int, qcovhsp double, scovhsp double, evalue double, bitscore double"
GFF3 = "seqid string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"
SNP_SUFFIXES = r"(_genomic_renamed\.fa\.ref|_genomic_renamed\.fa|_genomic\.fa|\.fa)$"


def path_tag(pattern: str, group: int = 0) -> Column:
    return first_match(F.input_file_name(), pattern, group)


def _by_header(spark: SparkSession, path: str | Sequence[str], header: str | None = None) -> dict[str, list[str] | str | Sequence[str]]:
    """Files by their header: the first line that starts with header, or the first line.

    The driver reads one line a file.  Where all files have one header the paths stay as they were given.
    """
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("k"))
    first = lines.where(F.col("value").startswith(header)) if header else lines.where("block = 0 and trim(value) <> ''")
    # Numbers are aggregated and only their lines are kept: text in an aggregate is sorted whole.
    at = first.groupBy("file").agg(F.min("k").alias("k"))
    found: dict[str, list[str]] = {}
    for r in first.join(F.broadcast(at), ["file", "k"]).select("file", F.col("value").alias("head")).orderBy("file").collect():
        found.setdefault(r["head"].rstrip("\r"), []).append(unquote(r["file"]))
    return {next(iter(found)): path} if len(found) == 1 else dict(found)


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _headed(spark: SparkSession, path: str | Sequence[str], sep: str = "\t") -> list[DataFrame]:
    """Delimited files with header lines, one table for each header among them, with the file as _file."""
    read = spark.read.option("header", True).option("sep", sep)
    return [read.csv(p).withColumn("_file", F.input_file_name()) for p in _by_header(spark, path).values()] or [read.csv(path).withColumn("_file", F.input_file_name())]


def _text_tables(spark: SparkSession, path: str | Sequence[str], header: str, sep: str = "\t") -> list[DataFrame]:
    """Delimited text whose header is the first line that starts with header, one table for each header; lines before it are comments."""
    heads = _by_header(spark, path, header)
    if not heads:
        raise ValueError(f"no header line {header!r} in {path}")

    def rows(names: list[str], p: str | Sequence[str]) -> DataFrame:
        lines = spark.read.text(p).withColumn("_file", F.input_file_name())
        body = lines.where(~F.col("value").startswith("#") & ~F.col("value").startswith(header) & (F.trim("value") != ""))
        parts = F.split("value", sep)
        return body.select("_file", *[F.coalesce(F.get(parts, F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])

    return [rows(head.split(sep), p) for head, p in heads.items()]


def emapper(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Annotations by query; columns that a version lacks are empty text."""
    names = {n: EMAPPER_ALIASES.get(n, ()) for n in EMAPPER} | {"_file": ()}
    out = _stacked([resolve_columns(x, names, F.lit("")) for x in _text_tables(spark, path, "#query")])
    return out.withColumn("accession", accession(F.col("_file"))).drop("_file")


def dbcan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Protein_ID, families (recommended ones, else of all tools), substrate, ec, accession."""
    df = _stacked([resolve_columns(x, DBCAN_ALIASES | {"_file": ()}, F.lit("")) for x in _headed(spark, path)])
    named, every = cazy_families(F.col("recommended")), cazy_families(F.col("hmm"), F.col("sub"), F.col("diamond"))
    families = F.array_join(F.when(F.size(named) > 0, named).otherwise(every), ", ")
    return df.select("Protein_ID", families.alias("CAZy"), "substrate", "ec", accession(F.col("_file")).alias("accession"))


def interproscan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row a protein: distinct IPR, GO, pathways, Pfam and EC in file order, in one aggregation."""
    raw = spark.read.schema(INTERPRO).option("sep", "\t").csv(path).withColumn("accession", accession(F.input_file_name())).withColumn("_at", F.monotonically_increasing_id())

    def seen(c: str, only: Column | None = None) -> Column:
        cell = F.when(F.lit(True) if only is None else only, F.col(c))
        items = F.transform(F.array_sort(F.collect_list(F.when(cell.isNotNull() & ~cell.isin("", "-"), F.struct(F.col("_at"), cell.alias("v"))))), lambda x: x["v"])
        return unique_join(items)

    grouped = raw.groupBy("accession", "Protein_ID").agg(seen("IPR_Acc").alias("IPR"), seen("IPR_Desc").alias("IPR_Desc"), seen("GO").alias("GO"), seen("Pathways").alias("Pathways"), seen("Signature_Acc", F.col("Analysis") == "Pfam").alias("PFAM"))
    return grouped.withColumn("EC", unique_join(ec_numbers(F.col("Pathways"))))


def signalp(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    parts = F.split("value", "\t")
    rows = lines.where(F.size(parts) >= 4).select(F.split(F.trim(parts[0]), r"\s+")[0].alias("Protein_ID"), parts[1].alias("prediction"), parts[2].try_cast("double").alias("other"), parts[3].try_cast("double").alias("sp"), accession(F.input_file_name()).alias("accession"))
    return rows.withColumn("secreted", F.contains(F.upper("prediction"), F.lit("SP")))


def ani(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) >= 3)
    return rows.select(accession(parts[0]).alias("accession"), parts[1].alias("reference"), parts[2].try_cast("double").alias("ani")).where("ani is not null")


def mash_distances(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) >= 5)
    name = lambda c: F.coalesce(accession(c), F.regexp_extract(c, r"([^/]+)$", 1))
    return rows.select(name(parts[0]).alias("a"), name(parts[1]).alias("b"), parts[2].try_cast("double").alias("distance"))


def alignments(spark: SparkSession, path: str | Sequence[str], schema: str = OUTFMT6) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)


#: A cell, in quotes or plain, with its separator before it; only lines that hold a quote are taken apart by it.
QUOTED = r'{0}("(?:[^"\\]++|\\.)*+"|[^{0}]*)'


def _split_cells(line: Column, sep: str) -> Column:
    """The cells of a line; quotes around one are taken off, and a backslash inside them escapes."""
    held = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(QUOTED.format(sep)), F.lit(1))
    bare = F.transform(held, lambda x: F.when(x.rlike('^".*"$'), F.regexp_replace(x.substr(F.lit(2), F.length(x) - 2), r'\\(["\\])', "$1")).otherwise(x))
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, sep))


def _wide_cells(spark: SparkSession, path: str | Sequence[str], named: Callable[[Column], Column], sep: str = "\t", without: Sequence[str] = (), counts: bool = False) -> DataFrame:
    """(og, h, cell) of the filled cells of wide files, h what named makes of a column's header; the first column is the key.

    Headers are joined to the cells, so neither the number of columns nor that of headers adds to the plan.  counts: cells of
    0 are left out as well.
    """
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("k"))
    first = lines.where("block = 0 and trim(value) <> ''")
    at = first.groupBy("file").agg(F.min("k").alias("k"))
    header = F.transform(_split_cells(F.col("value"), sep), lambda x, i: F.when(x == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(x))
    out = lambda x: x.isin(*without) if without else F.lit(False)
    heads = first.join(F.broadcast(at), ["file", "k"]).select("file", F.col("k").alias("_head"), header.alias("_h"))
    heads = heads.withColumn("_key", F.when(out(F.col("_h")[0]), 1).otherwise(0))
    named_ = F.broadcast(heads.select("_head", F.posexplode("_h").alias("_at", "_h")).where(~out(F.col("_h"))).select("_head", "_at", named(F.col("_h")).alias("h")))
    rows = lines.where("trim(value) <> ''").join(F.broadcast(heads.drop("_h")), "file").where("k <> _head")
    # What is carried beside a cell is short: an empty one, as most are, costs little.
    rows = rows.select("_head", "_key", _split_cells(F.col("value"), sep).alias("_cells")).select("_head", "_key", F.nullif(F.get("_cells", F.col("_key")), F.lit("")).alias("og"), F.posexplode("_cells").alias("_at", "cell"))
    return rows.where("cell <> '' and cell <> '0' and _at <> _key" if counts else "cell <> '' and _at <> _key").join(named_, ["_head", "_at"]).select("og", "h", "cell")


def orthogroups(spark: SparkSession, path: str | Sequence[str], species: str | None = None, combined: bool = False) -> DataFrame:
    """(og, [species,] accession, protein) from the wide matrix of comma-joined proteins; empty cells give no row.

    combined: headers are "species__accession..." and name the species too.
    """
    cells = _wide_cells(spark, path, lambda x: F.struct(F.coalesce(accession(x), x).alias("accession"), (species_label(x) if combined else F.lit(species)).alias("species")))
    protein = F.explode(F.filter(F.transform(F.split("cell", ","), lambda x: F.trim(x)), lambda x: x != ""))
    return cells.select("og", *(["h.species"] if combined or species else []), "h.accession", protein.alias("protein"))


def gene_counts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(og, species, accession, copies) from the wide count matrix, without its total."""
    cells = _wide_cells(spark, path, lambda x: F.struct(species_label(x).alias("species"), accession(x).alias("accession")), without=["Total"], counts=True)
    return cells.select("og", "h.species", "h.accession", F.col("cell").try_cast("int").alias("copies")).where("copies > 0")


def fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(id, sequence, file): records end at a line that starts with ">"."""
    rows = spark.read.option("lineSep", "\n>").text(path).withColumn("file", F.input_file_name()).withColumn("value", F.regexp_replace("value", "^>", "")).where(F.trim("value") != "")
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)"), r"\s", "")
    return rows.select(F.split(F.trim(head), r"\s+")[0].alias("id"), body.alias("sequence"), "file")


def snp_alignment(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(sample, pos, base), one row a site; labels lose their file suffixes."""
    rows = fasta(spark, path).select(F.regexp_replace("id", SNP_SUFFIXES, "").alias("sample"), "sequence")
    return rows.select("sample", F.posexplode(F.split("sequence", "")).alias("pos", "base")).where("base <> ''")


def gff_genes(spark: SparkSession, path: str | Sequence[str], kind: str = "gene") -> DataFrame:
    rows = spark.read.schema(GFF3).option("sep", "\t").option("comment", "#").csv(path)
    return rows.where(F.col("type") == kind).select(accession(F.input_file_name()).alias("accession"), F.col("seqid").alias("contig"), "start", "end", "strand", first_match(F.col("attributes"), r"ID=([^;]+)", 1).alias("gene"))


def bigscape(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cluster membership of several runs, tagged with the run's folder; reference clusters are marked."""
    names = {"record": ("Record", "#BGC Name"), "gbk": ("GBK",), "family": ("Family", "Family Number"), "_file": ()}
    df = _stacked([resolve_columns(x, names) for x in _headed(spark, path)]).withColumn("run", F.element_at(F.split("_file", "/"), -2)).drop("_file")
    return df.withColumn("is_reference", F.col("record").startswith("BGC")).withColumn("strain", F.coalesce(accession(F.col("record")), before_scaffold(F.col("record"))))


def known_clusters(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, rank, ref_id, compound, type, n_genes, score) from text blocks that ">>" begins; blocks that name no
    reference cluster are left out, and evidence that a block lacks is empty or 0."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    blocks = whole.select("file", F.posexplode(F.split("value", ">>")).alias("rank", "block")).where("rank > 0")
    pick = lambda p: F.trim(F.regexp_extract("block", p, 1))
    number = lambda p, kind: F.coalesce(pick(p).try_cast(kind), F.lit(0).cast(kind))
    rows = blocks.select("file", "rank", pick(r"(?m)^\s*\d+\.\s*(BGC\d+)").alias("ref_id"), pick(r"(?m)^Source:\s*(.*)$").alias("compound"), pick(r"(?m)^Type:\s*(.*)$").alias("type"), number(r"(?m)^Number of proteins with BLAST hits to this cluster:\s*(\d+)", "int").alias("n_genes"), number(r"(?m)^Cumulative BLAST score:\s*([\d.]+)", "double").alias("score"))
    return rows.where("ref_id <> ''")


ANTISMASH = "records array<struct<id:string, areas:array<struct<start:long, end:long, products:array<string>>>, features:array<struct<type:string, location:string, qualifiers:map<string,array<string>>>>>>"


def antismash(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(areas, genes): regions and coding sequences of cluster predictions, by accession and scaffold."""
    raw = spark.read.schema(ANTISMASH).option("multiLine", True).json(path).withColumn("accession", accession(F.input_file_name()))
    record = raw.select("accession", F.explode("records").alias("r")).select("accession", F.col("r.id").alias("scaffold"), "r.areas", "r.features")
    areas = record.select("accession", "scaffold", F.posexplode("areas").alias("region", "a")).select("accession", "scaffold", (F.col("region") + 1).alias("region"), F.col("a.start").alias("start"), F.col("a.end").alias("end"), F.array_join("a.products", ",").alias("product"))
    cds = record.select("accession", "scaffold", F.explode("features").alias("f")).where("f.type = 'CDS'")
    names = F.flatten(F.array_compact(F.array(*[F.try_element_at(F.col("f.qualifiers"), F.lit(q)) for q in ("locus_tag", "gene", "protein_id")])))
    ends = F.transform(F.regexp_extract_all(F.col("f.location"), F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("long"))
    genes = cds.select("accession", "scaffold", names.alias("names"), F.array_min(ends).alias("start"), F.array_max(ends).alias("end"))
    return areas, genes


def manual_places(spark: SparkSession, path: str) -> DataFrame:
    """(name, lat, lon) from a hand-written list of "Location: ... Lat: ... Lon: ..." paragraphs."""
    rows = spark.read.option("lineSep", "Location:").text(path).where(F.trim("value") != "")
    return rows.select(F.trim(F.substring_index("value", "\n", 1)).alias("name"), F.regexp_extract("value", r"(?i)lat\w*:\s*(-?[\d.]+)", 1).try_cast("double").alias("lat"), F.regexp_extract("value", r"(?i)lon\w*:\s*(-?[\d.]+)", 1).try_cast("double").alias("lon")).where("lat is not null and lon is not null")


def geocode_cache(spark: SparkSession, path: str) -> DataFrame:
    """(name, lat, lon) from a JSON object of name: [lat, lon]."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<double>>").alias("m"))
    return raw.select(F.explode("m").alias("name", "at")).where(F.size("at") == 2).select("name", F.col("at")[0].alias("lat"), F.col("at")[1].alias("lon"))


def panels(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Curated panels stacked by name, tagged with the file's first word as species."""
    raw = _stacked(_headed(spark, list(paths), ","))
    return raw.withColumn("species", F.regexp_extract("_file", r"([^/_]+)_[^/]*$", 1)).withColumn("panel", F.regexp_extract("_file", r"_([^/_]+)_panel[^/]*$", 1)).drop("_file")


def assembly_reports(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Assembly reports (JSON lines) flattened to the columns the analyses use; attributes become a map."""
    schema = "accession string, organism struct<organism_name:string, infraspecific_names:struct<strain:string, isolate:string>>, assembly_stats struct<number_of_contigs:long, contig_n50:long, total_sequence_length:string>, assembly_info struct<submitter:string, assembly_level:string, release_date:string, comments:string, biosample:struct<accession:string, description:struct<title:string, comment:string>, attributes:array<struct<name:string, value:string>>>>, wgs_info struct<wgs_project_accession:string>"
    raw = spark.read.schema(schema).json(path)
    attrs = F.map_from_entries(F.array_distinct(F.transform(F.array_sort(F.coalesce("assembly_info.biosample.attributes", F.array().cast("array<struct<name:string,value:string>>"))), lambda x: F.struct(x["name"], x["value"]))))
    pick = lambda n: F.try_element_at(F.col("attributes"), F.lit(n))
    return raw.withColumn("attributes", attrs).select("accession", F.col("organism.organism_name").alias("organism"), F.coalesce("organism.infraspecific_names.strain", "organism.infraspecific_names.isolate").alias("strain"), F.col("assembly_stats.number_of_contigs").alias("contigs"), F.col("assembly_stats.contig_n50").alias("n50"), F.col("assembly_stats.total_sequence_length").try_cast("long").alias("size"), F.col("assembly_info.submitter").alias("submitter"), F.col("assembly_info.biosample.description.title").alias("title"), F.coalesce("assembly_info.comments", "assembly_info.biosample.description.comment").alias("comment"), pick("isolation_source").alias("isolation_source"), pick("host").alias("host"), pick("geo_loc_name").alias("location"), pick("lat_lon").alias("lat_lon"), F.col("wgs_info.wgs_project_accession").alias("wgs"))


def busco_summary(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(accession, complete, total, percent) from short summaries."""
    whole = spark.read.text(path, wholetext=True)
    number = lambda p: F.regexp_extract("value", p, 1).try_cast("long")
    rows = whole.select(accession(F.input_file_name()).alias("accession"), number(r"(\d+)\s+Complete BUSCOs").alias("complete"), number(r"(\d+)\s+Total BUSCO groups").alias("total"))
    return rows.withColumn("percent", F.try_divide(F.col("complete") * 100.0, F.col("total")))


def accessions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(accession) of the files of folders, distinct; only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.select(accession(F.col("path")).alias("accession")).where("accession is not null").distinct()


def annotated_members(long: DataFrame, sources: Sequence[DataFrame], key: Sequence[str] = ("accession", "protein")) -> DataFrame:
    """Members left-joined with any number of annotation tables on the composite key, one partitioning for all."""
    out = long.repartition(*[F.col(k) for k in key])
    for s in sources:
        out = out.join(s.withColumnRenamed("Protein_ID", "protein"), list(key), "left")
    return out


def combined_cells(df: DataFrame, out: str, *cells: str) -> DataFrame:
    return df.withColumn(out, combine_annotations(*[F.col(c) for c in cells]))
