"""Column builders for identifiers, multi-valued cells, coordinates and sequence strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists that identifiers and cells are read by.
ACCESSION = r"GC[AF]_\d+\.\d+"
UNVERSIONED = r"(GC[AF]_\d+)"
TERM_SEPARATORS = r"[;,|]"
CAZY = r"\b(?:GH|GT|PL|CE|CBM|AA)\d+(?:_\d+)?\b"
EC = r"(?:EC:)?(\d+\.\d+\.\d+\.\d+)"
MISSING_CELLS = ("", "-", "nan")
MISSING_WORDS = ("missing", "not applicable", "na", "none", "unknown", "nan", "")
SPECIES_SUFFIX = r"(_ani_filtered|_filtered|_old)$"
STOPS = ("TAA", "TAG", "TGA")


def split_terms(c: Column, pattern: str = TERM_SEPARATORS) -> Column:
    """Terms of a multi-valued cell: trimmed, without empty ones; "-" and null give none."""
    cell = F.when(F.trim(c) == "-", F.lit("")).otherwise(F.coalesce(c, F.lit("")))
    return F.filter(F.transform(F.split(cell, pattern), lambda x: F.trim(x)), lambda x: x != "")


def unique_join(terms: Column, by: str = ", ") -> Column:
    """Distinct terms in the order in which they were first seen."""
    return F.array_join(F.array_distinct(F.filter(terms, lambda x: x.isNotNull() & ~F.trim(x).isin("", "-"))), by)


def combine_annotations(*cells: Column) -> Column:
    return unique_join(F.flatten(F.array(*[split_terms(c) for c in cells])))


def cazy_families(*cells: Column) -> Column:
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cells])
    return F.array_distinct(F.regexp_extract_all(text, F.lit(CAZY), F.lit(0)))


def ec_numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(EC), F.lit(1)))


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """The first match of pattern, or null."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def accession(c: Column) -> Column:
    return first_match(c, ACCESSION)


def unversioned(c: Column) -> Column:
    """The accession without version in any label; a label without accession stays as it is."""
    return F.coalesce(first_match(c, UNVERSIONED, 1), c)


def unversioned_exact(c: Column) -> Column:
    """Drops the version only where the whole label is an accession."""
    return F.when(c.rlike(rf"^{ACCESSION}$"), F.regexp_replace(c, r"\.\d+$", "")).otherwise(c)


def collapse_blanks(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def location_key(c: Column) -> Column:
    """Location text with even spacing after colons and commas."""
    return F.regexp_replace(F.regexp_replace(collapse_blanks(c), r"\s*:\s*", ": "), r"\s*,\s*", ", ")


def present(c: Column, missing: Sequence[str] = MISSING_CELLS) -> Column:
    """c, or null where it says that nothing is known."""
    return F.when(F.lower(F.trim(c)).isin(*missing), F.lit(None)).otherwise(c)


def is_annotated(c: Column) -> Column:
    return F.coalesce(~F.trim(c).isin(*MISSING_CELLS), F.lit(False))


def first_present(*cells: Column, missing: Sequence[str] = MISSING_WORDS) -> Column:
    return F.coalesce(*[present(c, missing) for c in cells])


def distinct_ignoring_case(values: Column, by: str = "; ") -> Column:
    """Values joined in order; of those that differ in case only, the first stays."""
    kept = F.aggregate(F.filter(values, lambda x: x.isNotNull() & (F.trim(x) != "")), F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return F.array_join(kept, by)


def parse_lat_lon(c: Column) -> Column:
    """struct<lat, lon> of "35.7 N 139.7 E" or "35.7, 139.7"; null for anything else."""
    parts = F.split(F.trim(F.regexp_replace(c, ",", " ")), r"\s+")
    number = lambda k: F.get(parts, F.lit(k)).try_cast("double")
    sign = lambda k, minus: F.when(F.upper(F.get(parts, F.lit(k))) == minus, -1.0).otherwise(1.0)
    four = F.struct((number(0) * sign(1, "S") + F.lit(0.0)).alias("lat"), (number(2) * sign(3, "W") + F.lit(0.0)).alias("lon"))
    two = F.struct(number(0).alias("lat"), number(1).alias("lon"))
    found = F.when(F.size(parts) == 4, four).when(F.size(parts) == 2, two)
    known = ~F.lower(F.trim(c)).isin(*MISSING_WORDS)
    return F.when(known & found["lat"].isNotNull() & found["lon"].isNotNull(), found)


def combined_text(*cells: Column) -> Column:
    """Cells joined by " | ", absent ones as empty text."""
    return F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])


def contrast_name(c: Column) -> Column:
    return F.concat(F.translate(F.lower(c), "- ", "__"), F.lit("_vs_rest"))


def focus_label(c: Column) -> Column:
    """A feature's name without orthogroup and cluster prefixes."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^(OG|N\d+\.HOG|FAM_|GCF_?)0*", ""), r"_+", " "))


def strain_of_record(c: Column) -> Column:
    return F.substring_index(c, "_", 2)


def before_scaffold(c: Column) -> Column:
    return F.split(c, "_scaffold").getItem(0)


def species_label(c: Column) -> Column:
    """The species of a "species__accession" header, without its suffix."""
    return F.regexp_replace(F.split(c, "__").getItem(0), SPECIES_SUFFIX, "")


def epithet(c: Column) -> Column:
    """The species part of a binomial or label, in lower case."""
    parts = F.split(F.lower(F.translate(F.trim(c), "_.", "  ")), r"\s+")
    return F.element_at(parts, -1)


def recode(c: Column, names: Mapping[str, str], default: Column | None = None) -> Column:
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), default if default is not None else c)


def gc_percent(c: Column) -> Column:
    """Share of the letters G and C in a sequence, in per cent; null for an empty one."""
    n = F.length(c)
    return F.when(n > 0, F.lit(100.0) * (n - F.length(F.translate(c, "GCgc", ""))) / n)


def cds_flags(c: Column) -> Column:
    """struct<starts, stops, in_frame> of a coding sequence."""
    s = F.upper(c)
    return F.struct(s.startswith("ATG").alias("starts"), F.substring(s, -3, 3).isin(*STOPS).alias("stops"), (F.length(s) % 3 == 0).alias("in_frame"))


def quality_score(busco_percent: Column, contigs: Column, n50: Column) -> Column:
    """busco - contigs / 100 + n50 / 1e6; shares up to 1 are taken as per cent; null if any part is."""
    b = F.when(busco_percent <= 1, busco_percent * 100).otherwise(busco_percent)
    return b - contigs * F.lit(0.01) + n50 * F.lit(1e-6)


def depth_transform(c: Column, kind: str = "none", power: float = 0.5) -> Column:
    return {"none": c, "log": F.log1p(c), "sqrt": F.sqrt(c), "power": F.pow(c, F.lit(power))}[kind]


def region_number(c: Column) -> Column:
    """The number in a padded region name."""
    return F.regexp_extract(c, r"region0*(\d+)", 1).try_cast("int")


def gene_aliases(c: Column) -> Column:
    """The names under which a gene may be listed: as is, without transcript suffix, with source prefix."""
    bare = F.regexp_replace(c, r"-T\d+$", "")
    return F.array_distinct(F.array(c, bare, F.concat(F.lit("ncbi_"), bare)))


def gene_label(name: Column, pfam: Column, description: Column, width: int = 26) -> Column:
    """Name, else first family, else the description's start, cut to width."""
    return F.substring(F.coalesce(present(name), F.get(split_terms(pfam), F.lit(0)), present(description), F.lit("unknown")), 1, width)


def genbank_field(c: Column, field: str = "DEFINITION") -> Column:
    """The text of a GenBank field, its continuation lines joined."""
    return collapse_blanks(first_match(c, rf"(?s){field}\s+(.*?)(?:\n\S|\z)", 1))


def wgs_master(c: Column) -> Column:
    """The master record of a WGS accession: its letters and zeros."""
    return F.regexp_replace(c, r"^([A-Z]{4,6})(\d{2})\d*$", "$1$2000000")


def xml_text(c: Column, tag: str) -> Column:
    return F.xpath_string(c, F.lit(f"//{tag}"))
