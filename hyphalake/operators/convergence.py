"""Results of several species on common features: mapping, convergence, meta-analysis and null models."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.functions.special import binomial_test, chi2_even_sf, clopper_pearson
from hyphalake.operators.relational import average_ranks, best_row, bh_qvalues, dealt, item_pairs
from hyphalake.sources.shared import kept


def shared_member_map(left: DataFrame, right: DataFrame, member: Sequence[str], a: str = "og", b: str = "combined_og", n: int | None = None) -> DataFrame:
    """(a, b): groups of left and right that hold the same member; member is a composite key.  n: rows of left, to deal links by."""
    both = left.select(*member, a).join(right.select(*member, b), list(member)).select(a, b)
    return (both if n is None else dealt(both, n, a)).distinct()


def map_accounting(links: DataFrame, a: str = "og", b: str = "combined_og") -> DataFrame:
    """One row: links, distinct sides, links beyond the first on either side; links - extra = distinct on each side."""
    na = links.groupBy(a).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_left"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("split_extra"))
    nb = links.groupBy(b).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_right"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("merge_extra"))
    return na.crossJoin(nb).select((F.col("n_left") + F.col("split_extra")).alias("n_links"), "n_left", "n_right", "split_extra", "merge_extra")


def transfer(results: DataFrame, links: DataFrame, a: str = "og") -> DataFrame:
    """Results on the combined features: one row for every link of a feature."""
    return results.join(links, a)


def merge_results(results: DataFrame, key: Sequence[str], rule: str = "best") -> DataFrame:
    """One row a key from several: best p, median effect with least p, or keys with a single row only."""
    if rule == "best":
        pick = F.min_by(F.struct("beta", "pvalue"), F.struct("pvalue", "beta")).alias("x")
        return results.groupBy(*key).agg(pick).select(*key, "x.beta", "x.pvalue")
    if rule == "median":
        return results.groupBy(*key).agg(F.median("beta").alias("beta"), F.min("pvalue").alias("pvalue"))
    if rule == "single":
        return results.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first("beta").alias("beta"), F.first("pvalue").alias("pvalue")).where("n = 1").drop("n")
    raise ValueError(rule)


def convergent_pairs(results: DataFrame, feature: str = "og", group: str = "species", q: float = 0.1) -> DataFrame:
    """Features significant in two groups: the best row of each, and whether they point the same way."""
    top = best_row(results.where(F.col("qvalue") < q), [group, feature], [F.col("pvalue"), F.col("beta")])
    x, y = top.alias("x"), top.alias("y")
    both = x.join(y, (F.col(f"x.{feature}") == F.col(f"y.{feature}")) & (F.col(f"x.{group}") < F.col(f"y.{group}")))
    same = F.signum("x.beta") == F.signum("y.beta")
    return both.select(F.col(f"x.{feature}").alias(feature), F.col(f"x.{group}").alias("group_a"), F.col(f"y.{group}").alias("group_b"), F.col("x.beta").alias("beta_a"), F.col("y.beta").alias("beta_b"), F.when(same & (F.col("x.beta") > 0), "enriched").when(same, "depleted").otherwise("opposite").alias("direction"))


def convergent_hits(results: DataFrame, feature: str = "og", group: str = "species", q: float = 0.1, min_significant: int = 2, moderate_p: float = 0.1, min_consistent: int = 3) -> DataFrame:
    """Features with support in several groups: significant and in one direction, else consistent at moderate p.

    Enrichment is asked before depletion.
    """
    up, down = F.col("beta") > 0, F.col("beta") < 0
    n = lambda c: F.countDistinct(F.when(c, F.col(group)))
    s = results.groupBy(feature).agg(n((F.col("qvalue") < q) & up).alias("sig_up"), n((F.col("qvalue") < q) & down).alias("sig_down"), n((F.col("pvalue") < moderate_p) & up).alias("mod_up"), n((F.col("pvalue") < moderate_p) & down).alias("mod_down"))
    kind = F.when(F.col("sig_up") >= min_significant, F.struct(F.lit("significant").alias("support"), F.lit("enriched").alias("direction"))).when(F.col("sig_down") >= min_significant, F.struct(F.lit("significant").alias("support"), F.lit("depleted").alias("direction"))).when(F.col("mod_up") >= min_consistent, F.struct(F.lit("consistent").alias("support"), F.lit("enriched").alias("direction"))).when(F.col("mod_down") >= min_consistent, F.struct(F.lit("consistent").alias("support"), F.lit("depleted").alias("direction")))
    return s.withColumn("k", kind).where("k is not null").select(feature, "sig_up", "sig_down", "mod_up", "mod_down", "k.support", "k.direction")


def compare_features(results: DataFrame, a: str, b: str, feature: str = "feature", group: str = "species", q: float = 0.1) -> DataFrame:
    """Features tested in both groups and where they are significant."""
    x = results.where(F.col(group) == a).select(feature, F.col("beta").alias("beta_a"), (F.col("qvalue") < q).alias("sig_a"))
    y = results.where(F.col(group) == b).select(feature, F.col("beta").alias("beta_b"), (F.col("qvalue") < q).alias("sig_b"))
    same = F.signum("beta_a") == F.signum("beta_b")
    kind = F.when(F.col("sig_a") & F.col("sig_b") & same, "shared").when(F.col("sig_a") & F.col("sig_b"), "opposite").when(F.col("sig_a"), "first only").when(F.col("sig_b"), "second only").otherwise("neither")
    return x.join(y, feature).withColumn("category", kind)


def meta_analysis(results: DataFrame, feature: str = "og", min_groups: int = 2) -> DataFrame:
    """Fisher's and Stouffer's combined p of every feature, q over all features, direction and heterogeneity.

    p is clipped to 1e-300; Fisher's statistic has an even number of degrees of freedom, so its tail is a
    finite sum; heterogeneous: least p below 0.01 and the second above 0.1.
    """
    p = F.greatest(F.col("pvalue"), F.lit(1e-300))
    ps = F.array_sort(F.collect_list("pvalue"))
    agg = results.where("pvalue is not null").groupBy(feature).agg(F.count(F.lit(1)).alias("k"), (-2 * F.sum(F.log(p))).alias("chi2"), ps.alias("ps"), F.sum(_z(p) * F.signum("beta")).alias("z_sum"), F.count_if(F.col("beta") > 0).alias("n_up"), F.count_if(F.col("beta") < 0).alias("n_down"))
    agg = agg.where(F.col("k") >= min_groups)
    out = agg.withColumn("fisher_p", F.least(F.lit(1.0), chi2_even_sf(F.col("chi2"), F.col("k")))).withColumn("stouffer_z", F.col("z_sum") / F.sqrt("k"))
    direction = F.when(F.col("n_down") == 0, "enriched").when(F.col("n_up") == 0, "depleted").otherwise("mixed")
    out = out.withColumn("direction", direction).withColumn("heterogeneous", (F.col("ps")[0] < 0.01) & (F.col("ps")[1] > 0.1))
    return bh_qvalues(out.drop("ps", "z_sum"), p="fisher_p")


def cross_species_report(results: DataFrame, links: DataFrame, pair: tuple[str, str], feature: str = "og", combined: str = "combined_og", group: str = "species", q: float = 0.1, moderate_p: float = 0.1, alpha: float = 0.05) -> DataFrame:
    """(section, item, n): what two species have in common, from their results and the map to combined features.

    pairs: features of the map significant in both, by direction.  features: own features tested in both, by
    where they are significant.  hits: support and direction over the map.  meta: combined tests, those below
    alpha, and their directions.  Results on the map are the best of each combined feature, with their own q.
    """
    a, b = pair
    own = kept(bh_qvalues(results.where(F.col(group).isin(a, b)), by=[group]), "own")
    moved = merge_results(transfer(own.drop("qvalue"), links, feature), [group, combined], "best")
    moved = kept(bh_qvalues(moved, by=[group]), "moved")
    part = lambda df, section, item: df.groupBy(F.lit(section).alias("section"), item.alias("item")).agg(F.count(F.lit(1)).alias("n"))
    meta = kept(meta_analysis(moved, combined), "meta")
    sections = [
        part(convergent_pairs(moved, combined, group, q), "pairs", F.col("direction")),
        part(compare_features(own, a, b, feature, group, q), "features", F.col("category")),
        part(convergent_hits(moved, combined, group, q, 2, moderate_p, 2), "hits", F.concat_ws(" ", "support", "direction")),
        part(meta, "meta", F.lit("tested")),
        part(meta.where(F.col("fisher_p") < alpha), "meta", F.lit("significant")),
        part(meta, "meta", F.col("direction")),
    ]
    out = sections[0]
    for x in sections[1:]:
        out = out.unionByName(x)
    return out


def _z(p: Column) -> Column:
    """Upper normal quantile of p / 2 by a rational approximation (absolute error below 4.5e-4)."""
    t = F.sqrt(-2 * F.log(F.greatest(p / 2, F.lit(1e-300))))
    return t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)


def direction_agreement(pairs: DataFrame, a: str = "beta_a", b: str = "beta_b", by: Sequence[str] = ()) -> DataFrame:
    """Sign agreement of paired effects with exact p and interval, Pearson and Spearman correlation."""
    used = kept(pairs.where((F.col(a) != 0) & (F.col(b) != 0)), "pairs")
    ranked = average_ranks(average_ranks(used, a, "_ra", by), b, "_rb", by)
    stats = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.signum(a) == F.signum(b)).alias("n_same"), F.corr(a, b).alias("pearson"), F.corr("_ra", "_rb").alias("spearman"))

    @F.pandas_udf("p double, low double, high double")
    def exact(k: pd.Series, n: pd.Series) -> pd.DataFrame:
        rows = [(binomial_test(int(i), int(j)), *clopper_pearson(int(i), int(j))) for i, j in zip(k, n)]
        return pd.DataFrame(rows, columns=["p", "low", "high"])

    return stats.withColumn("e", exact("n_same", "n")).select(*by, "n", "n_same", (F.col("n_same") / F.col("n")).alias("agreement"), F.col("e.p").alias("binomial_p"), F.col("e.low").alias("ci_low"), F.col("e.high").alias("ci_high"), "pearson", "spearman")


def random_sets(background: DataFrame, size: int, n_perm: int, seed: str, item: str = "og") -> DataFrame:
    """(perm, item): for each permutation the items with the smallest keyed digests, so draws repeat on every run.

    Digests are uniform, so those below a threshold that leaves a few more than ``size`` hold the smallest: all
    others are dropped where they are made, and only what is left is sorted, permutation by permutation.  A
    permutation with too few below it, which a margin of eight deviations makes all but impossible, has all
    drawn again with a wider one.
    """
    each = kept(background.select(item).distinct(), "background")
    n, margin = each.count(), 8.0
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("perm").cast("string"), F.col(item).cast("string")))
    spread = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a short table, but a digest for each row and permutation
    while True:
        part = (size + margin * math.sqrt(size) + 2 * margin) / max(n, 1)
        drawn = each.repartition(spread, item).withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1)))).withColumn("_h", digest)
        if part < 1:
            drawn = drawn.where(F.col("_h") < f"{int(part * 2**64):016x}")
        drawn = kept(drawn, "drawn")
        if part >= 1 or drawn.groupBy("perm").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= size).count() == n_perm:
            break
        margin *= 4
    w = Window.partitionBy("perm").orderBy("_h", item)
    return drawn.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= size).select("perm", item)


def overlap_null(background_a: DataFrame, background_b: DataFrame, n_a: int, n_b: int, n_perm: int, item: str = "og", seed: str = "42") -> DataFrame:
    """(perm, overlap) of random sets of the observed sizes, permutations without overlap included."""
    a, b = random_sets(background_a, n_a, n_perm, f"{seed}a", item), random_sets(background_b, n_b, n_perm, f"{seed}b", item)
    both = a.join(b, ["perm", item]).groupBy("perm").agg(F.count(F.lit(1)).alias("overlap"))
    return background_a.sparkSession.range(n_perm).select(F.col("id").cast("int").alias("perm")).join(both, "perm", "left").select("perm", F.coalesce("overlap", F.lit(0)).alias("overlap"))


def null_summary(null: DataFrame, observed: int, value: str = "overlap") -> DataFrame:
    """Mean, deviation, empirical p (no correction) and its corrected form."""
    n, hit = F.count(F.lit(1)), F.count_if(F.col(value) >= observed)
    return null.agg(F.lit(observed).alias("observed"), F.avg(value).alias("null_mean"), F.stddev_samp(value).alias("null_sd"), (hit / n).alias("p_empirical"), ((hit + 1) / (n + 1)).alias("p_corrected"))


def term_jaccard_null(terms: DataFrame, sets_a: DataFrame, sets_b: DataFrame, item: str = "og") -> DataFrame:
    """(perm, layer, jaccard) of the term sets that two families of item sets carry; empty with empty gives 0."""
    ta = sets_a.join(terms, item).select("perm", "layer", "term").distinct()
    tb = sets_b.join(terms, item).select("perm", "layer", "term").distinct()
    both = ta.withColumn("a", F.lit(1)).join(tb.withColumn("b", F.lit(1)), ["perm", "layer", "term"], "full_outer")
    return both.groupBy("perm", "layer").agg((F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()) / F.count(F.lit(1))).alias("jaccard"))


def shared_between_families(members: DataFrame, family: str = "family", item: str = "og", group: str = "species", heavy: int = 1000) -> DataFrame:
    """Common items of every two families of different groups, a pair in the order of the groups; items in very many
    families are dealt over keys of their own."""
    m = kept(members.select(F.struct(F.col(group).alias("g"), F.col(family).alias("f")).alias("of"), F.col(item).alias("item")).distinct(), "members")
    both = item_pairs(m, "item", "of", heavy).where("of_a.g <> of_b.g")
    return both.groupBy(F.col("of_a.f").alias("family_a"), F.col("of_b.f").alias("family_b")).agg(F.count(F.lit(1)).alias("n_shared"))
