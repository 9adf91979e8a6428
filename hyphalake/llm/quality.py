"""Quality classifier by hierarchical empirical Bayes.

A logistic model over surface features gives each document's evidence.  Site evidence is added by
grouped sums: a document counts for its path and host with its label where it has one and with the
model's probability else.  Hosts are shrunk to the global rate, paths to their host, each with a prior
strength that the spread between groups gives by the method of moments, so a sparse site stays near
its prior.  The verdict adds the document's log-odds and what its path's posterior differs from the
global rate in log-odds.

Scale: a text is read once; features (a short float array a row) are kept in the shared folder.  The
model is fitted on about ``train_rows`` labelled rows (a share of the keys' hashes; never twice as many),
the bound on what reaches the driver.  Site
sums are pre-aggregated before their shuffle, and the posterior table is joined on the path; where a
path holds a third of all rows the join is split by adaptive execution.

Defined cases: null text counts as empty; null host or path is a site of its own; a document with
several labels counts with their mean; without labels of both classes the model is even and all is
kept; repeated rows each get a row; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.llm.common import Scratch, in_fixed_order, release

FEATURES = ("log_words", "word_chars", "long_words", "distinct", "top_word", "top_three", "repeats", "symbols", "odd_tails", "pipes", "digits", "upper", "marks", "sentence_words", "lines", "repeated_lines", "sparse_letters")
_SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_MARKS = re.compile(r"[.,;:!?]")
_ENDS = re.compile(r"[.!?]+(?:\s|$)")


def features(text: str | None) -> list[float]:
    """Surface features of one whole text, in the order of FEATURES."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    top = counts.most_common(3)
    lines = [x for x in text.split("\n") if x]
    letters = sum(map(len, words))
    symbols = _SYMBOLS.findall(text)
    odd = sum(1 for w in words if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        float(np.log1p(n)),
        letters / n,
        sum(len(w) > 14 for w in words) / n,
        len(counts) / n**0.8,
        top[0][1] / n,
        sum(c for _, c in top) / n,
        same / n,
        len(symbols) / chars,
        odd / n,
        text.count("|") / n,
        sum(map(text.count, "0123456789")) / chars,
        sum(1 for w in words if w[0].isupper()) / n,
        len(_MARKS.findall(text)) / n,
        float(np.log1p(n / (1 + len(_ENDS.findall(text))))),
        float(np.log1p(len(lines))) / float(np.log1p(n)),
        1 - len(set(lines)) / max(1, len(lines)),
        1 - letters / chars,
    ]


def feature_rows(docs: DataFrame, key: str, text: str, host: Column, path: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(b.column(4)[k].as_py()) for k in range(len(b))], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], x], ["row", "doc_id", "host", "path", "x"])
        release()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, host string, path string, x array<float>")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> tuple[np.ndarray, float]:
    """Weights and intercept for raw features, by Newton steps on standardised ones and their squares' hinge."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack((np.ones(len(x)), (x - mean) / sd))
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    return w[1:] / sd, float(w[0] - (w[1:] * mean / sd).sum())


def widened(x: np.ndarray) -> np.ndarray:
    """Features with their square roots, for shares that matter from the first few per cent on."""
    return np.column_stack((x, np.sqrt(np.abs(x))))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(q / (1 - q))


def _strength(groups: DataFrame, s: str, n: str, prior: str) -> float:
    """Prior strength of a Beta by the method of moments: how many rows the level above is worth."""
    m = F.col(s) / F.col(n)
    got = groups.where(f"{n} > 0").agg(F.sum(n).alias("n"), F.sum(F.col(n) ** 2).alias("nn"), F.sum(F.col(n) * (m - F.col(prior)) ** 2).alias("ss"), F.sum(F.col(n) * F.col(prior) * (1 - F.col(prior))).alias("v"), F.count(F.lit(1)).alias("k")).first()
    if not got.n or got.k < 2:
        return 1.0
    within = got.v / got.n
    between = (got.ss - got.k * within) / max(got.n - got.nn / got.n, 1e-9)
    return float(min(1e4, max(1.0, within / between - 1))) if between > 0 else 1e4


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: Sequence[str] = ("source", "lang"), label: str = "quality", train_rows: int = 20_000, keep_at: float = 0.5) -> DataFrame:
    """One row a row of docs: row (by scan order), doc_id, doc_logit, host_rate, path_rate, probability, keep."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "quality")
    site = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in path])
    rows = scratch.keep(feature_rows(docs, key, text, F.coalesce(F.col(host).cast("string"), F.lit("\x00")), site), "features")
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("double").alias("y")).where("_id is not null and y is not null").groupBy("_id").agg(F.avg("y").alias("y"))
    labelled = rows.join(marks, rows.doc_id == marks["_id"])
    # A share of the keys' hashes, so that no task sends more than its part of the bounded sample.
    n_labelled = labelled.count()
    share = min(1.0, train_rows / max(1, n_labelled))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = labelled.where(chosen).select("x", "y").limit(2 * train_rows).toPandas()
    size = 2 * len(FEATURES)
    if len(sample) and 0 < (y := sample.y.to_numpy()).mean() < 1:
        weights, bias = fit_logistic(widened(np.vstack(sample.x.to_numpy()).astype(float)), y)
    else:
        weights, bias = np.zeros(size), 0.0
    half = len(FEATURES)
    terms = [F.col("x")[i].cast("double") * float(weights[i]) + F.sqrt(F.abs(F.col("x")[i].cast("double"))) * float(weights[half + i]) for i in range(half)]
    logit = F.lit(float(bias))
    for t in terms:
        logit = logit + t
    scored = rows.select("row", "doc_id", "host", "path", F.least(F.greatest(logit, F.lit(-12.0)), F.lit(12.0)).alias("doc_logit"))
    scored = scratch.keep(scored, "scored")

    # Grouped evidence: paths first, hosts from paths, the globe from hosts.
    seen = scored.join(marks, scored.doc_id == marks["_id"], "left").withColumn("e", F.coalesce("y", 1 / (1 + F.exp(-F.col("doc_logit")))))
    paths = scratch.keep(seen.groupBy("host", "path").agg(F.sum("e").alias("s"), F.count(F.lit(1)).cast("double").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    globe = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    rate = float(globe.s / globe.n) if globe.n else 0.5
    hosts = hosts.withColumn("prior", F.lit(rate))
    k_host = _strength(hosts, "hs", "hn", "prior")
    hosts = hosts.select("host", ((F.col("hs") + k_host * rate) / (F.col("hn") + k_host)).alias("host_rate"))
    sites = paths.join(hosts, "host")
    k_path = _strength(sites, "s", "n", "host_rate")
    sites = sites.select("path", "host_rate", ((F.col("s") + k_path * F.col("host_rate")) / (F.col("n") + k_path)).alias("path_rate"))
    shift = _logit(F.col("path_rate")) - _logit(F.lit(rate))
    out = scored.join(sites, "path").withColumn("probability", 1 / (1 + F.exp(-(F.col("doc_logit") + shift))))
    return out.select("row", "doc_id", "doc_logit", "host_rate", "path_rate", "probability", (F.col("probability") >= keep_at).alias("keep"))


def kept_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: Sequence[str] = ("source", "lang"), **options) -> DataFrame:
    """The rows of docs that are not rejected, in the columns of docs; each row by its own text, whatever keys they share."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    own = own if in_fixed_order(docs) else Scratch(docs.sparkSession, "quality").keep(own, "input")
    bad = score_documents(own, labels, at[key], at[text], at[host], [at[c] for c in path], **options).where("not keep").select("row")
    left = own.withColumn("row", F.monotonically_increasing_id()).join(bad, "row", "left_anti")
    return left.select(*[F.col(f"own_{k}").alias(c) for k, c in enumerate(docs.columns)])
