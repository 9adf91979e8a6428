"""Weighted pattern rules as column expressions, and the isolate classifier built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyphalake.functions import rule_tables as R
from hyphalake.functions.text import MISSING_WORDS, collapse_blanks

Rules = Sequence[tuple[str, str]]

# Field names by preference, and words that guards look for.
FIELDS = {
    "isolation_source": ("isolation_source", "Isolation Source", "isolationSource"),
    "host": ("host", "Host"),
    "env_biome": ("env_broad_scale", "env_biome", "env_local_scale", "env_medium"),
    "geo_loc_name": ("geo_loc_name", "geoLocName", "geographic_location", "Geo Location"),
    "description": ("BioSample Description Title", "biosample_title", "title", "description"),
    "comment": ("Comment", "comment", "Comments"),
    "strain": ("Organism Infraspecific Names Strain", "Strain", "strain", "Organism Infraspecific Names Isolate", "isolate", "Isolate"),
    "submitter": ("Assembly Submitter", "submitter"),
    "bioproject_title": ("BioProject Title", "bioproject_title"),
    "bioproject_description": ("BioProject Description", "bioproject_description"),
    "annotation_text": ("annotation_text", "CombinedText"),
    "species": ("Species", "species", "Organism Name"),
}
OUTDOOR = ("soil", "compost", "air ", "water", "sediment", "leaf litter", "dust", "cave", "marine", "mangrove", "permafrost")
PATIENT = ("patient", "sputum", "lung", "blood", "clinical", "bronch", "infection", "aspergillosis", "cornea", "wound")
FERMENT = ("ferment", "koji", "sake", "miso", "soy", "industrial", "enzyme", "citric", "daqu", "nuruk")
PRODUCER = ("citric acid produc", "enzyme produc", "industrial produc", "fermentation strain")
LIQUOR = ("liquor", "daqu", "qu ", "ferment", "vinegar", "baijiu")
TOXIN = ("ochratoxin", "fumonisin", "mycotoxin", "aflatoxin")
DISEASE_MARKS = ("patient", "hospital", "icu", "bal", "sputum", "lung", "respiratory", "wound", "abscess", "pus", "infection", "aspergillosis", "clinical isolate", "clinical sample", "biopsy", "swab", "cornea", "eye", "sinus", "nasal", "ear", "oral", "diseased", "infected", "veterinary")
GUT_MARKS = ("fec", "stool", "microbiome", "survey")
MEDIA = ("sheep blood", "agar", "pda", "medium", "broth")
OLD_CLASS = {"Human-pathogenic": "Human", "Animal-pathogenic": "Animal", "Plant-pathogenic": "Plant", "Industrial-trait": "Industrial", "Environmental": "Environmental", "Unknown": "Unknown"}
USAGE = {"Human-pathogenic": "Pathogenic", "Animal-pathogenic": "Pathogenic", "Plant-pathogenic": "Pathogenic", "Industrial-trait": "Industrial", "Environmental": "Wild-type", "Unknown": "Unknown"}
INDUSTRY_TERMS = ("citric acid", "enzyme", "ferment", "producer", "production", "industrial", "biotechnology", "bioprocess")
FOOD_TERMS = ("sake", "miso", "soy sauce", "shoyu", "koji")


def hits(text: Column, rules: Rules) -> Column:
    """Number of rules that match the text, each once."""
    total = F.lit(0)
    for pattern, _ in rules:
        total = total + text.rlike(f"(?i){pattern}").cast("int")
    return total


def ascii_bounds(rules: Rules) -> Rules:
    """The rules with word bounds between ASCII letters, digits and underscores and all others, as RE2 has them."""
    return tuple((p.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"), name) for p, name in rules)


def labels(text: Column, rules: Rules) -> Column:
    """Labels of the rules that match, in the rules' order."""
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(name)) for p, name in rules]))


def winner(scores: Mapping[str, Column]) -> Column:
    """struct<top, score, margin> of named scores; the first named wins ties."""
    ranked = F.sort_array(F.array(*[F.struct(c.cast("double").alias("score"), F.lit(-k).alias("order"), F.lit(n).alias("name")) for k, (n, c) in enumerate(scores.items())]), asc=False)
    return F.struct(ranked[0]["name"].alias("top"), ranked[0]["score"].alias("score"), (ranked[0]["score"] - ranked[1]["score"]).alias("margin"))


def confidence(w: Column, hard: float = R.WEIGHT_HARD) -> Column:
    return F.when(w["score"] == 0, "low").when(w["margin"] >= 2 * hard, "high").when((w["margin"] >= hard) | (w["score"] >= hard), "medium").otherwise("low")


def any_word(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def _pick(df: DataFrame, names: Sequence[str]) -> Column:
    there = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in there]) if there else F.lit(None).cast("string")


def classify_isolates(df: DataFrame, fields: Mapping[str, Sequence[str]] = FIELDS) -> DataFrame:
    """df with provenance and phenotype, their confidence and scores, and the older class columns.

    Provenance is where an isolate comes from and phenotype what it does; both are the best-scoring
    class of their rules.  Guards follow in a fixed order: outdoor sources, toxins in industry, industrial
    provenance, established strains, inference from provenance; then rules on species and submitter.
    """
    given = df.columns
    out = df
    for name, candidates in fields.items():
        raw = collapse_blanks(_pick(df, candidates))
        out = out.withColumn(f"_{name}", F.when(F.lower(raw).isin(*MISSING_WORDS), None).otherwise(raw))
    out = out.withColumn("_all", F.concat_ws(" | ", *[F.col(f"_{n}") for n in fields]))
    text, low = F.col("_all"), F.lower(F.col("_all"))
    iso = F.lower(F.coalesce("_isolation_source", F.lit("")))
    out = out.withColumn("_neg", hits(text, R.NEGATION_PATTERNS))
    neg = F.col("_neg")
    hard, medium = R.WEIGHT_HARD, R.WEIGHT_MEDIUM
    prov = {"Clinical": hits(text, R.PROV_CLINICAL) * hard, "Environmental": hits(text, R.PROV_ENVIRONMENTAL) * medium, "Industrial-origin": hits(text, R.PROV_INDUSTRIAL) * hard, "Culture-derived": hits(text, R.PROV_CULTURE) * medium}
    less = lambda rules: F.greatest(F.lit(0.0), (hits(text, rules) - neg) * F.lit(hard))
    pheno = {
        "Human-pathogenic": less(R.PHENO_HUMAN_PATHOGEN),
        "Animal-pathogenic": F.when(neg > 0, 0.0).otherwise(hits(text, R.PHENO_ANIMAL_PATHOGEN) * hard),
        "Plant-pathogenic": less(R.PHENO_PLANT_PATHOGEN),
        "Industrial-trait": hits(text, R.PHENO_INDUSTRIAL_TRAIT) * hard,
        "Environmental": (hits(text, R.PHENO_ENVIRONMENTAL) + neg) * medium,
    }
    out = out.withColumn("ProvenanceScores", F.create_map(*[x for n, c in prov.items() for x in (F.lit(n), c.cast("double"))]))
    out = out.withColumn("PhenotypeScores", F.create_map(*[x for n, c in pheno.items() for x in (F.lit(n), c.cast("double"))]))
    out = out.withColumn("_p", winner({n: F.col("ProvenanceScores")[n] for n in prov})).withColumn("_f", winner({n: F.col("PhenotypeScores")[n] for n in pheno}))
    out = out.withColumn("Provenance", F.when(F.col("_p.score") == 0, "Unknown").otherwise(F.col("_p.top"))).withColumn("ProvenanceConfidence", confidence(F.col("_p")))
    out = out.withColumn("Phenotype", F.when(F.col("_f.score") == 0, "Unknown").otherwise(F.col("_f.top"))).withColumn("PhenotypeConfidence", confidence(F.col("_f")))

    def rule(frame: DataFrame, when: Column, phenotype: Column | str, sure: str) -> DataFrame:
        """Sets the phenotype where a condition on the columns so far holds."""
        to = F.lit(phenotype) if isinstance(phenotype, str) else phenotype
        frame = frame.withColumn("_w", F.coalesce(when, F.lit(False)))
        return frame.withColumn("Phenotype", F.when(F.col("_w"), to).otherwise(F.col("Phenotype"))).withColumn("PhenotypeConfidence", F.when(F.col("_w"), F.lit(sure)).otherwise(F.col("PhenotypeConfidence")))

    is_p, is_f = (lambda x: F.col("Provenance") == x), (lambda x: F.col("Phenotype") == x)
    direct = F.when(is_f("Human-pathogenic"), any_word(iso, PATIENT)).when(is_f("Industrial-trait"), any_word(iso, FERMENT) | any_word(low, PRODUCER)).otherwise(True)
    out = rule(out, is_p("Environmental") & any_word(iso, OUTDOOR) & ~direct, "Environmental", "medium")
    plant = labels(text, R.PHENO_PLANT_PATHOGEN)
    toxins_only = (F.size(plant) > 0) & F.forall(plant, lambda x: any_word(x, TOXIN))
    out = rule(out, is_f("Plant-pathogenic") & (any_word(iso, LIQUOR) | F.contains(F.lower(F.coalesce("_submitter", F.lit(""))), F.lit("industrial"))) & toxins_only, "Industrial-trait", "high")
    out = rule(out, is_p("Industrial-origin"), "Industrial-trait", "high")
    strain = F.lit(None).cast("string")
    for _, patterns, kind in reversed(R.ESTABLISHED_STRAINS):
        match = F.lit(False)
        for p in patterns:
            match = match | text.rlike(f"(?i){p}")
        strain = F.when(match, F.lit(kind)).otherwise(strain)
    named = {v: k for k, v in OLD_CLASS.items()}
    out = out.withColumn("_strain", strain)
    out = rule(out, F.col("_strain").isNotNull(), F.create_map(*[F.lit(x) for kv in named.items() for x in kv])[F.col("_strain")], "high")
    marks = F.lower(F.array_join(labels(text, R.PROV_CLINICAL), "', '"))
    gut = any_word(marks, GUT_MARKS)
    ill = (any_word(marks, DISEASE_MARKS) | (F.contains(marks, F.lit("blood")) & ~F.contains(low, F.lit("sheep")))) & ~(gut & any_word(low, MEDIA))
    out = out.withColumn("_open", is_f("Unknown"))
    inferred = F.when(ill & ~gut, "Human-pathogenic").when(gut, "Environmental").otherwise("Unknown")
    out = rule(out, F.col("_open") & is_p("Clinical"), inferred, "low")
    out = rule(out, F.col("_open") & is_p("Environmental"), "Environmental", "low")

    # Knowledge about species, projects and submitters; each rule sees what those before it left.
    species, project = F.lower(F.coalesce("_species", F.lit(""))), F.lower(F.coalesce("_bioproject_description", F.lit("")))
    out = rule(out, F.contains(iso, F.lit("ferment")) & is_f("Environmental"), "Industrial-trait", "medium")
    out = rule(out, F.contains(species, F.lit("oryzae")) & F.contains(iso, F.lit("food")) & is_f("Environmental"), "Industrial-trait", "medium")
    evidence = F.concat_ws(" ", F.lower(F.array_join(labels(text, R.PHENO_INDUSTRIAL_TRAIT), " ")), F.lower(F.array_join(labels(text, R.PROV_INDUSTRIAL), " ")), project)
    out = rule(out, F.contains(species, F.lit("oryzae")) & (iso == "soil") & is_f("Industrial-trait") & ~any_word(evidence, INDUSTRY_TERMS + FOOD_TERMS), "Environmental", "medium")
    out = rule(out, F.contains(species, F.lit("niger")) & (iso == "soil") & is_f("Industrial-trait") & ~any_word(evidence, INDUSTRY_TERMS), "Environmental", "medium")
    bench = iso.rlike(r"^lab(oratory)?$") & is_f("Unknown")
    out = rule(out, bench & F.contains(project, F.lit("industrial")), "Industrial-trait", "medium")
    out = rule(out, bench & is_f("Unknown") & any_word(project, ("marine", "sponge")), "Environmental", "medium")
    out = out.withColumn("_open", is_f("Unknown"))
    tamed = F.contains(species, F.lit("oryzae")) & F.contains(project, F.lit("domestication"))
    out = rule(out, F.col("_open") & tamed, "Industrial-trait", "medium")
    out = rule(out, F.col("_open") & ~tamed & any_word(project, ("lignocellulosic", "degradation potential")), "Environmental", "low")
    out = rule(out, F.coalesce("_submitter", F.lit("")).rlike("(?i)FDA|Food and Drug Administration") & ~is_f("Human-pathogenic"), "Human-pathogenic", "medium")
    old = F.create_map(*[F.lit(x) for kv in OLD_CLASS.items() for x in kv])[F.col("Phenotype")]
    use = F.create_map(*[F.lit(x) for kv in USAGE.items() for x in kv])[F.col("Phenotype")]
    out = out.withColumn("IsolationClass", old).withColumn("UsageClass", use).withColumn("ClassConfidence", F.col("PhenotypeConfidence"))
    added = ["Provenance", "ProvenanceConfidence", "ProvenanceScores", "Phenotype", "PhenotypeConfidence", "PhenotypeScores", "IsolationClass", "UsageClass", "ClassConfidence"]
    return out.select(*[F.col(f"`{c}`") for c in given if c not in added], *added)


def kingdom(organism: Column) -> Column:
    """Kingdom named by the first key word list that occurs in an organism's name."""
    low = F.lower(organism)
    out = None
    for name, words in R.KINGDOMS:
        out = F.when(any_word(low, words), name) if out is None else out.when(any_word(low, words), name)
    return F.when(organism.isNull() | (F.trim(organism) == ""), "Unknown").otherwise(out.otherwise("Unknown"))
