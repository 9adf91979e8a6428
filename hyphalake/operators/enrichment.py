"""Term enrichment: contingency counts from exploded terms, Fisher's test, false-discovery control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.functions.special import fisher_column
from hyphalake.functions.text import split_terms
from hyphalake.operators.relational import best_row, bh_qvalues
from hyphalake.sources.shared import kept


def feature_terms(consensus: DataFrame, key: Sequence[str], columns: Sequence[str], keep: Sequence[str] = (), separators: str = "[;,|]") -> DataFrame:
    """(key, kept columns, layer, term), each term once a feature, for all layers in one pass."""
    layers = F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.array_distinct(split_terms(F.col(c).cast("string"), separators)).alias("terms")) for c in columns]))
    return consensus.select(*key, *keep, layers.alias("x")).select(*key, *keep, "x.layer", F.explode("x.terms").alias("term"))


def class_counts(terms: DataFrame, classes: Sequence[str] = ("Core", "Accessory"), by: Sequence[str] = (), feature: str = "og", class_col: str = "pangenome_class", min_count: int = 5) -> DataFrame:
    """a, b, c, d of every (layer, term, class): the background is the features annotated in the layer.

    A feature has one class, so a term's margin is the sum of its counts by class; the layers' margins are few rows.
    """
    keys = [*by, "layer"]
    wanted = F.col(class_col).isin(*classes)
    n = terms.select(*keys, feature, class_col).distinct().groupBy(*keys, class_col).agg(F.count(F.lit(1)).alias("n_class"))
    n = n.withColumn("n_all", F.sum("n_class").over(Window.partitionBy(*keys)))
    a = terms.groupBy(*keys, "term", class_col).agg(F.countDistinct(feature).alias("a")).withColumn("n_term", F.sum("a").over(Window.partitionBy(*keys, "term")))
    joined = a.where(wanted & (F.col("n_term") >= min_count)).join(F.broadcast(n.where(wanted)), [*keys, class_col])
    return joined.select(*keys, "term", class_col, "a", (F.col("n_class") - F.col("a")).alias("b"), (F.col("n_term") - F.col("a")).alias("c"), (F.col("n_all") - F.col("n_class") - F.col("n_term") + F.col("a")).alias("d"))


def odds_ratio(a: Column, b: Column, c: Column, d: Column) -> Column:
    """ad / bc; infinite where only bc is zero, null where both are."""
    top, low = (a * d).cast("double"), (b * c).cast("double")
    return F.when(low > 0, top / low).when(top > 0, F.lit(float("inf")))


def fold(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Observed over expected number in the first cell."""
    return F.try_divide(a * (a + b + c + d), ((a + b) * (a + c)).cast("double"))


def tested(counts: DataFrame, alternative: str = "two-sided", by: Sequence[str] = ("layer",), q: float = 0.05) -> DataFrame:
    """counts with odds ratio, fold, p, q (within by) and whether q passes."""
    cells = [F.col(x) for x in "abcd"]
    out = counts.withColumn("odds_ratio", odds_ratio(*cells)).withColumn("fold", fold(*cells)).withColumn("pvalue", fisher_column(*cells, alternative))
    return bh_qvalues(kept(out, "tests"), by=by).withColumn("significant", F.col("qvalue") <= q)


def class_enrichment(consensus: DataFrame, columns: Sequence[str], by: Sequence[str] = (), min_count: int = 5, q: float = 0.05, **options) -> DataFrame:
    """Terms enriched or depleted in core and accessory features; tables with a < 1 or d < 0 are not tested."""
    terms = feature_terms(consensus, [*by, "og"], columns, ["pangenome_class"])
    counts = class_counts(terms, by=by, min_count=min_count, **options).where("a >= 1 and d >= 0")
    return tested(counts, by=[*by, "layer"], q=q).withColumn("direction", F.when(F.col("fold") > 1, "enriched").otherwise("depleted"))


def hit_counts(terms: DataFrame, hits: DataFrame, background: DataFrame, by: Sequence[str] = (), feature: str = "og", min_background: int = 3) -> DataFrame:
    """a, b, c, d of significant features against all tested ones, by term and group of hits.

    hits: (by, feature); background: (feature).  Hits need not be annotated.
    """
    bg = background.select(feature).distinct()
    n_all = bg.agg(F.count(F.lit(1)).alias("n_all"))
    sig = hits.select(*by, feature).distinct()
    n_sig = sig.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sig"))
    in_bg = terms.select("layer", "term", feature).distinct().join(bg, feature, "left_semi")
    n_term = in_bg.groupBy("layer", "term").agg(F.count(F.lit(1)).alias("n_term")).where(F.col("n_term") >= min_background)
    a = in_bg.join(sig, feature).groupBy(*by, "layer", "term").agg(F.count(F.lit(1)).alias("a"))
    joined = a.join(n_term, ["layer", "term"])
    joined = joined.join(F.broadcast(n_sig), list(by)) if by else joined.join(F.broadcast(n_sig))
    joined = joined.join(F.broadcast(n_all))
    return joined.select(*by, "layer", "term", "a", (F.col("n_sig") - F.col("a")).alias("b"), (F.col("n_term") - F.col("a")).alias("c"), (F.col("n_all") - F.col("n_sig") - F.col("n_term") + F.col("a")).alias("d"))


def letter_counts(features: DataFrame, letters: str, by: Sequence[str] = (), column: str = "COG_category", flag: str = "is_rare", min_total: int = 3) -> DataFrame:
    """a, b, c, d of flagged against other features for every letter of a category string."""
    each = features.select(*by, F.col(flag).alias("f"), F.explode(F.filter(F.split(F.col(column), ""), lambda x: F.length(x) == 1)).alias("term")).where(F.contains(F.lit(letters), F.col("term")))
    n = each.groupBy(*by, "term").agg(F.count_if("f").alias("a"), F.count_if(~F.col("f")).alias("b"))
    w = Window.partitionBy(*by)
    n = n.withColumn("_fa", F.sum("a").over(w)).withColumn("_fb", F.sum("b").over(w))
    return n.where(F.col("a") + F.col("b") >= min_total).select(*by, "term", "a", "b", (F.col("_fa") - F.col("a")).alias("c"), (F.col("_fb") - F.col("b")).alias("d"))


def strongest_terms(results: DataFrame, by: Sequence[str] = (), k: int = 25, clip: float = 8.0) -> DataFrame:
    """The k terms with the largest clipped |log2 odds ratio| in any class."""
    size = F.abs(F.greatest(F.lit(-clip), F.least(F.lit(clip), F.log2(F.greatest(F.col("odds_ratio"), F.lit(1e-9))))))
    top = results.groupBy(*by, "layer", "term").agg(F.max(size).alias("effect"))
    return best_row(top, [*by], [F.desc("effect"), F.col("layer"), F.col("term")], k)
