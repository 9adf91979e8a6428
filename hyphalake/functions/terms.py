"""Which annotation terms say something: the predicate by layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms that name no function, by layer, and descriptions that mark one.
EMPTY_COG = ("S", "R")
ROOT_GO = ("GO:0003674", "GO:0008150", "GO:0005575")
EMPTY_EC = ("-.-.-.-", "-", "")
EMPTY_DESCRIPTIONS = ("uncharacterised", "uncharacterized", "hypothetical protein", "protein of unknown function", "domain of unknown function")
SECRETION_GO = ("GO:0005576", "GO:0005615", "GO:0031012", "GO:0005618", "GO:0009986", "GO:0046930", "GO:0006887", "GO:0032940")
PROTEASE_PFAM = ("PF00082", "PF00026", "PF00089", "PF01546", "PF00246", "PF01435", "PF00814", "PF00675", "PF00112", "PF01650", "PF00560", "PF03572", "PF00557", "PF01432")
TRANSPORTER_PFAM = ("PF00005", "PF00664", "PF00083", "PF07690", "PF00324", "PF01490", "PF01061", "PF00854", "PF01699", "PF00520", "PF01566", "PF03092")


def is_informative(layer: Column, term: Column, description: Column | None = None) -> Column:
    """True for terms that enrichment should test."""
    t = F.trim(term)
    d = F.lower(F.coalesce(description, F.lit(""))) if description is not None else F.lit("")
    vague = F.lit(False)
    for p in EMPTY_DESCRIPTIONS:
        vague = vague | F.contains(d, F.lit(p))
    duf = F.upper(t).startswith("DUF")
    kept = (
        F.when(layer == "COG_category", ~F.upper(t).isin(*EMPTY_COG))
        .when(layer.isin("PFAMs", "interpro_IPR"), ~duf & ~vague)
        .when(layer == "KEGG_ko", ~vague)
        .when(layer == "GOs", ~t.isin(*ROOT_GO))
        .when(layer == "EC", ~t.isin(*EMPTY_EC))
        .otherwise(F.lit(True))
    )
    return F.coalesce((t != "") & (F.lower(t) != "nan") & kept, F.lit(False))
