"""The isolate classifier, row by row, against one row at a time in plain Python with the same tables."""

from __future__ import annotations

import random
import re

from hyphalake.functions import rule_tables as R
from hyphalake.functions import rules
from hyphalake.functions.text import MISSING_WORDS

H, M = R.WEIGHT_HARD, R.WEIGHT_MEDIUM


def found(table, text):
    return [name for pattern, name in table if re.search(pattern, text, re.IGNORECASE)]


def has(text, words):
    return any(w in text for w in words)


def best(scores):
    order = sorted(scores.items(), key=lambda kv: -kv[1])  # stable: the first named wins ties
    (name, top), second = order[0], order[1][1]
    sure = "low" if top == 0 else "high" if top - second >= 2 * H else "medium" if top - second >= H or top >= H else "low"
    return ("Unknown" if top == 0 else name), sure


def plain(row):
    f = {}
    for name, columns in rules.FIELDS.items():
        raw = next((row[c] for c in columns if row.get(c) is not None and row[c].strip(" ") != ""), None)
        raw = None if raw is None else re.sub(r"\s+", " ", raw).strip(" ")
        f[name] = None if raw is None or raw.lower() in MISSING_WORDS else raw
    text = " | ".join(v for v in f.values() if v is not None)
    low, iso = text.lower(), (f["isolation_source"] or "").lower()
    n = lambda table: len(found(table, text))
    neg = n(R.NEGATION_PATTERNS)
    prov, prov_sure = best({"Clinical": n(R.PROV_CLINICAL) * H, "Environmental": n(R.PROV_ENVIRONMENTAL) * M, "Industrial-origin": n(R.PROV_INDUSTRIAL) * H, "Culture-derived": n(R.PROV_CULTURE) * M})
    kind, sure = best({"Human-pathogenic": max(0, n(R.PHENO_HUMAN_PATHOGEN) - neg) * H, "Animal-pathogenic": 0 if neg else n(R.PHENO_ANIMAL_PATHOGEN) * H, "Plant-pathogenic": max(0, n(R.PHENO_PLANT_PATHOGEN) - neg) * H, "Industrial-trait": n(R.PHENO_INDUSTRIAL_TRAIT) * H, "Environmental": (n(R.PHENO_ENVIRONMENTAL) + neg) * M})
    direct = has(iso, rules.PATIENT) if kind == "Human-pathogenic" else has(iso, rules.FERMENT) or has(low, rules.PRODUCER) if kind == "Industrial-trait" else True
    if prov == "Environmental" and has(iso, rules.OUTDOOR) and not direct:
        kind, sure = "Environmental", "medium"
    plants = found(R.PHENO_PLANT_PATHOGEN, text)
    submitter = f["submitter"] or ""
    if kind == "Plant-pathogenic" and (has(iso, rules.LIQUOR) or "industrial" in submitter.lower()) and plants and all(has(p, rules.TOXIN) for p in plants):
        kind, sure = "Industrial-trait", "high"
    if prov == "Industrial-origin":
        kind, sure = "Industrial-trait", "high"
    strain = next((k for _, patterns, k in R.ESTABLISHED_STRAINS if any(re.search(p, text, re.IGNORECASE) for p in patterns)), None)
    if strain:
        kind, sure = next(k for k, v in rules.OLD_CLASS.items() if v == strain), "high"
    marks = "', '".join(found(R.PROV_CLINICAL, text)).lower()
    gut = has(marks, rules.GUT_MARKS)
    ill = (has(marks, rules.DISEASE_MARKS) or "blood" in marks and "sheep" not in low) and not (gut and has(low, rules.MEDIA))
    if kind == "Unknown" and prov == "Clinical":
        kind, sure = "Human-pathogenic" if ill and not gut else "Environmental" if gut else "Unknown", "low"
    elif kind == "Unknown" and prov == "Environmental":
        kind, sure = "Environmental", "low"
    species, project = (f["species"] or "").lower(), (f["bioproject_description"] or "").lower()
    if "ferment" in iso and kind == "Environmental":
        kind, sure = "Industrial-trait", "medium"
    if "oryzae" in species and "food" in iso and kind == "Environmental":
        kind, sure = "Industrial-trait", "medium"
    evidence = " ".join([" ".join(found(R.PHENO_INDUSTRIAL_TRAIT, text)).lower(), " ".join(found(R.PROV_INDUSTRIAL, text)).lower(), project])
    if "oryzae" in species and iso == "soil" and kind == "Industrial-trait" and not has(evidence, rules.INDUSTRY_TERMS + rules.FOOD_TERMS):
        kind, sure = "Environmental", "medium"
    if "niger" in species and iso == "soil" and kind == "Industrial-trait" and not has(evidence, rules.INDUSTRY_TERMS):
        kind, sure = "Environmental", "medium"
    if re.search(r"^lab(oratory)?$", iso) and kind == "Unknown":
        if "industrial" in project:
            kind, sure = "Industrial-trait", "medium"
        elif has(project, ("marine", "sponge")):
            kind, sure = "Environmental", "medium"
    if kind == "Unknown":
        if "oryzae" in species and "domestication" in project:
            kind, sure = "Industrial-trait", "medium"
        elif has(project, ("lignocellulosic", "degradation potential")):
            kind, sure = "Environmental", "low"
    if re.search("FDA|Food and Drug Administration", submitter, re.IGNORECASE) and kind != "Human-pathogenic":
        kind, sure = "Human-pathogenic", "medium"
    return prov, prov_sure, kind, sure, rules.OLD_CLASS[kind], rules.USAGE[kind]


WORDS = """patient;sputum of a patient;clinical isolate;hospital air;soil;compost;garden soil, field;air ;sediment;koji;sake;miso;soy sauce fermentation;fermented soybean;citric acid production;enzyme producer;
liquor daqu;baijiu starter;maize kernel with aflatoxin;peanut;ochratoxin in grapes;stool survey;fecal sample, microbiome;blood;sheep blood agar;agar plate;not pathogenic;non-pathogenic strain;no disease;healthy donor;
bronchoalveolar lavage;aspergillosis;keratitis cornea;bird lung;kakapo;Rhipicephalus tick;livestock disease;infected wound;lab;laboratory;food;marine sponge;industrial strain;ATCC 1015;CBS 513.88;RIB40;NRRL 21882;Af293;A1163;mutant collection;culture collection;
unknown;missing;NA;not applicable; ;type strain;leaf litter;mangrove sediment;rice;wheat bran;genome of an industrial fungus;FGSC A1513""".replace("\n", "").split(";")


def test_classifier_row_by_row(spark):
    rng = random.Random(17)
    columns = {"isolation_source": 0.8, "Host": 0.3, "env_medium": 0.2, "Comment": 0.3, "title": 0.3, "Strain": 0.4, "submitter": 0.4, "BioProject Title": 0.2, "bioproject_description": 0.3, "Species": 0.8, "isolate": 0.2}
    special = {"Species": ["Aspergillus oryzae", "Aspergillus niger", "Aspergillus flavus"], "submitter": ["FDA", "Food and Drug Administration", "Industrial Institute", "A university"], "bioproject_description": ["domestication of koji mold", "lignocellulosic degradation potential", "industrial strains", "marine sponge", "citric acid producers"]}
    rows = []
    for k in range(1500):
        r = {c: None for c in columns}
        for c, share in columns.items():
            if rng.random() < share:
                r[c] = " ".join(rng.sample(special[c] if c in special and rng.random() < 0.8 else WORDS, 1 if rng.random() < 0.7 or c in special else 2))
        rows.append(r | {"k": k})
    frame = spark.createDataFrame([tuple(r[c] for c in [*columns, "k"]) for r in rows], ", ".join(f"`{c}` string" for c in columns) + ", k int")
    names = ["Provenance", "ProvenanceConfidence", "Phenotype", "PhenotypeConfidence", "IsolationClass", "UsageClass"]
    got = {r.k: tuple(r[n] for n in names) for r in rules.classify_isolates(frame).select("k", *names).collect()}
    want = {r["k"]: plain(r) for r in rows}
    wrong = [(rows[k], got[k], want[k]) for k in want if got[k] != want[k]]
    assert not wrong, (len(wrong), wrong[0])
    assert len(set(want.values())) > 20 and len({w[2] for w in want.values()}) == 6
