"""Small relational operators shared by the analyses: top-k, shares, false-discovery control, sets, joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hyphalake.sources.shared import kept


def resolve_columns(df: DataFrame, aliases: dict[str, Sequence[str]], fill: Column | None = None) -> DataFrame:
    """One column a name: the first of its candidates that df has, compared without case and punctuation; else fill."""
    plain = lambda s: "".join(ch for ch in s.lower() if ch.isalnum())
    have = {plain(c): c for c in reversed(df.columns)}
    cols = []
    for name, candidates in aliases.items():
        found = next((have[plain(c)] for c in [name, *candidates] if plain(c) in have), None)
        cols.append((F.col(f"`{found}`") if found else (fill if fill is not None else F.lit(None).cast("string"))).alias(name))
    return df.select(*cols)


def best_row(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows a group in the given order; order should end in a tie-breaker."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


#: Groups on a side of a square of counts (a power of 2), and pairs that are added to it at a time.
SIDE, PAIRS = 512, 2_000_000
#: Words of 64 bits of a set's parities, where pairs of sets are looked for.
WORDS = 8
#: Rows that a task takes, about, where tables are dealt by their size.
ROWS = 500_000


def dealt(df: DataFrame, n: int, *keys: str, rows: int | None = None) -> DataFrame:
    """df by keys in as many tasks as n rows need, so that what a task holds does not grow with the table.

    Groupings and joins by these keys, or by these and others, stay where they are dealt.
    """
    return df.repartition(max(1, -(-n // (rows or ROWS))), *keys)


def cut_points(df: DataFrame, value: str, parts: int = 64) -> list:
    """At most parts - 1 values that cut df's about evenly; none where a part would have fewer than a thousand rows."""
    share = [k / parts for k in range(1, parts)]
    found = df.agg(F.count(value).alias("n"), F.approx_percentile(value, share, 1000).alias("q")).first()
    few = min(parts, (found.n or 0) // 1000)
    return sorted(set((found.q or [])[parts // few - 1 :: parts // few])) if few > 1 else []


def _part(value: str, cuts: list) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(value))) if cuts else F.lit(0)


def cumulative(counts: DataFrame, keys: Sequence[str], value: str, n: str, cuts: list) -> DataFrame:
    """counts (keys, value, n), a row a distinct value, with _part, _upto (n summed over values up to it) and _total.

    Two passes: sums of n by part of the values' range, then sums within each part, so that no task sorts
    more than a part of a group.
    """
    parted = counts.withColumn("_part", _part(value, cuts))
    group = Window.partitionBy(*keys)
    sums = parted.groupBy(*keys, "_part").agg(F.sum(n).alias("_s"))
    sums = sums.select(*[F.col(k).alias(f"_{k}_") for k in keys], F.col("_part").alias("_p_"), (F.sum("_s").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_s")).alias("_before"), F.sum("_s").over(group).alias("_total"))
    within = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return _met(parted, sums, keys).withColumn("_upto", F.col("_before") + F.sum(n).over(within)).drop("_before")


def _met(parted: DataFrame, of_parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = F.col("_part") == F.col("_p_")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}_"))
    return parted.join(of_parts, on).drop("_p_", *[f"_{k}_" for k in keys])


def average_ranks(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """df with the rank of each value in its group, ties at the mean of their places."""
    counts = df.groupBy(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts, keys = kept(counts, "counts"), [f"_by{k}" for k in range(len(by))]
    ranks = cumulative(counts, keys, "_v", "_n", cut_points(counts, "_v")).select(*keys, "_v", (F.col("_upto") - (F.col("_n") - 1) / 2.0).alias(out))
    on = F.col(value).eqNullSafe(F.col("_v"))
    for c, k in zip(by, keys):
        on = on & F.col(c).eqNullSafe(F.col(k))
    return df.join(ranks, on).drop(*keys, "_v")


def bh_qvalues(df: DataFrame, p: str = "pvalue", by: Sequence[str] = (), out: str = "qvalue") -> DataFrame:
    """Benjamini-Hochberg step-up q-values in each group of tests; a null p takes no part and gets null.

    Tied p-values get equal q-values whatever their order: ranks and the running minimum from the largest p
    down are taken over the distinct p-values, which are counted before they meet, and joined back.  Both
    are made in parts of the range of p, each with what the parts before or behind it come to, so that a
    group with most of the tests, or the only one, is not one task.
    """
    keys = [f"_by{k}" for k in range(len(by))]
    counts = df.where(F.col(p).isNotNull()).groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    counts = kept(counts, "counts")
    raw = cumulative(counts, keys, "_p", "_n", cut_points(counts, "_p")).withColumn("_raw", F.col("_p") * F.col("_total") / F.col("_upto"))
    behind = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    lows = raw.groupBy(*keys, "_part").agg(F.min("_raw").alias("_m"))
    lows = lows.select(*[F.col(k).alias(f"_{k}_") for k in keys], F.col("_part").alias("_p_"), F.min("_m").over(behind).alias("_low"))
    within = Window.partitionBy(*keys, "_part").orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0)
    n = _met(raw, lows, keys).select(*keys, "_p", F.least(F.lit(1.0), F.min("_raw").over(within), "_low").alias("_q"))
    on = F.col(p) == F.col("_p")
    for c, k in zip(by, keys):
        on = on & F.col(c).eqNullSafe(F.col(k))
    return df.join(n, on, "left").withColumn(out, F.col("_q")).drop(*keys, "_p", "_q")


def share(df: DataFrame, by: Sequence[str], within: Sequence[str] = (), out: str = "pct") -> DataFrame:
    """Counts by group and their share, in per cent, of the counts that agree on within."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn(out, F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(*within)))


def crosstab_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of a by b with both margins and the total, which are named All."""
    n = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    named = lambda c, g: F.when(F.col(g) == 1, "All").otherwise(F.col(c).cast("string")).alias(c)
    return n.select(named(a, "_ga"), named(b, "_gb"), "n")


def pivot_counts(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, total: str | None = None) -> DataFrame:
    """Counts with one column a value, absent ones 0, and their total."""
    wide = df.groupBy(*rows).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    if total:
        added = F.lit(0)
        for v in values:
            added = added + F.col(f"`{v}`")
        wide = wide.withColumn(total, added.cast("long"))
    return wide


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts of a value in equal bins, empty ones included; the last bin holds the upper end."""
    at = F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / (high - low) * bins)).cast("int")
    seen = df.where(F.col(value).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(seen, "bin", "left").select("bin", (F.lit(low) + F.col("bin") * ((high - low) / bins)).alias("start"), F.coalesce("n", F.lit(0)).alias("n"))


def item_pairs(rows: DataFrame, item: str, group: str, heavy: int = 1000) -> DataFrame:
    """Pairs of rows of different groups that hold the same item, columns with suffix _a and _b, group_a < group_b.

    A group has an item once.  An item in more than ``heavy`` groups is dealt to parts, and each pair of parts is
    a key of its own, so no key meets more than twice ``heavy`` rows, whatever the item's frequency.
    """
    often = rows.groupBy(item).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > heavy).select(F.col(item).alias("_i"), F.ceil(F.col("_m") / heavy).cast("int").alias("_q"))
    dealt = rows.join(often, F.col(item) == F.col("_i"), "left").withColumn("_q", F.coalesce("_q", F.lit(1))).withColumn("_p", F.pmod(F.xxhash64(group), F.col("_q")).cast("int"))
    cell = F.explode(F.transform(F.sequence(F.lit(0), F.col("_q") - 1), lambda j: F.struct(F.least("_p", j).alias("x"), F.greatest("_p", j).alias("y"))))
    dealt = dealt.withColumn("_c", cell).select(*rows.columns, "_p", F.col("_c.x").alias("_x"), F.col("_c.y").alias("_y"))
    one, two = (dealt.select([F.col(c).alias(f"{c}_{s}") for c in dealt.columns]) for s in "ab")
    same = (F.col(f"{item}_a") == F.col(f"{item}_b")) & (F.col("_x_a") == F.col("_x_b")) & (F.col("_y_a") == F.col("_y_b"))
    apart = (F.col("_x_a") == F.col("_y_a")) | (F.col("_p_a") != F.col("_p_b"))
    return one.join(two, same & apart & (F.col(f"{group}_a") < F.col(f"{group}_b"))).drop(*[f"{c}_{s}" for c in ("_p", "_x", "_y") for s in "ab"])


def similar_sets(sets: DataFrame, least: float, heavy: int = 1000, words: int = 0) -> DataFrame:
    """(a, b, shared, n_a, n_b) of all pairs of sets (key, items) whose Jaccard index is ``least`` (above 0) or more.

    Sets within the limit share an item among the rarest of each, as many as leave too few for the least
    overlap (a prefix filter), so an item that most sets hold is never joined, and items of one set only are
    dropped before.  What the prefixes share and the rest could bounds the overlap; the exact one is taken for
    pairs that pass.  With ``words``, each set has the parities of its items' hashes in as many words of 64 bits: where two
    differ, an item is in one set only, so pairs that differ in more bits than the limit leaves items are dropped where they meet.
    """
    own = kept(sets.select("key", "items", F.size("items").alias("n")).where("n > 0"), "sets")
    items = own.select("key", "n", F.explode("items").alias("item"))
    several = items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    by = Window.partitionBy("key")
    ranked = items.join(several, "item").withColumn("m", F.count(F.lit(1)).over(by)).withColumn("r", F.row_number().over(by.orderBy("df", "item")))
    prefix = F.greatest(F.lit(0), F.col("m") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1)
    rare = ranked.withColumn("p", prefix).where("r <= p").select("key", "item", "n", (F.col("m") - F.col("p")).alias("rest"))
    apart = F.lit(0)
    if words:
        bit = F.pmod(F.xxhash64("item"), F.lit(64 * words)).cast("int")
        parities = items.withColumn("_b", bit).groupBy("key").agg(*[F.bit_xor(F.expr(f"if(_b div 64 = {k}, shiftleft(1L, _b % 64), 0L)")).alias(f"_w{k}") for k in range(words)])
        rare = rare.join(parities, "key")
        for k in range(words):
            apart = apart + F.bit_count(F.col(f"_w{k}_a").bitwiseXOR(F.col(f"_w{k}_b")))
    rare = kept(rare, "rare")
    met = item_pairs(rare, "item", "key", heavy).where(F.least("n_a", "n_b") >= F.lit(least) * F.greatest("n_a", "n_b") - 1e-9)
    if words:
        met = met.where(apart <= F.lit((1 - least) / (1 + least)) * (F.col("n_a") + F.col("n_b")) + 1e-9)
    met = met.groupBy("key_a", "key_b").agg(F.count(F.lit(1)).alias("c"), F.first(F.col("n_a") + F.col("n_b")).alias("n"), F.first(F.greatest("rest_a", "rest_b")).alias("rest"))
    asked = kept(met.where(F.col("c") + F.col("rest") >= F.lit(least / (1 + least)) * F.col("n") - 1e-9).select("key_a", "key_b"), "asked")
    held = lambda s: own.select(F.col("key").alias(f"key_{s}"), F.col("items").alias(f"s_{s}"), F.col("n").alias(f"n_{s}"))
    both = asked.join(held("a"), "key_a").join(held("b"), "key_b").withColumn("shared", F.size(F.array_intersect("s_a", "s_b")).cast("long"))
    return both.where(F.col("shared") >= F.lit(least) * (F.col("n_a") + F.col("n_b") - F.col("shared")) - 1e-9).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "shared", "n_a", "n_b")


def shared_counts(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b, shared, n_a, n_b) of every two groups, a < b, that share an item; rows of members (g, i) are distinct, sizes are (g, n).

    Groups are cut in order into blocks of SIDE.  An item sends its places in two blocks to the cell of both, which adds
    its pairs to one dense square: what is shuffled is places, never pairs, and a task holds a square.
    """
    order = sizes.where("g is not null").repartitionByRange(max(1, -(-sizes.count() // SIDE)), "g").sortWithinPartitions("g")
    numbered = kept(order.select("g", "n", F.monotonically_increasing_id().alias("k")), "groups")
    at = F.col("k").bitwiseAND(SIDE - 1)
    placed = members.join(numbered.select("g", "k"), "g").groupBy("i", (F.col("k") - at).alias("x")).agg(F.collect_list(at.cast("int")).alias("p"))
    placed = kept(placed, "places")
    met = placed.join(placed.select("i", F.col("x").alias("y"), F.col("p").alias("q")), "i").where("x < y or x = y and size(p) > 1")

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, total = None, np.zeros(SIDE * SIDE, np.int64)

        def emptied() -> Iterator[pa.RecordBatch]:
            square = total.reshape(SIDE, SIDE)
            a, b = np.nonzero(np.triu(square, 1) if cell[0] == cell[1] else square)
            yield pa.RecordBatch.from_arrays([pa.array(cell[0] + a), pa.array(cell[1] + b), pa.array(square[a, b])], ["ka", "kb", "shared"])
            total[:] = 0

        for batch in batches:
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1).tolist(), len(x)]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                if cell is not None and cell != (x[low], y[low]):
                    yield from emptied()
                cell = (x[low], y[low])
                whole = [batch.column(c).slice(low, high - low) for c in (2, 3)]
                upto, start = np.cumsum(np.prod([np.diff(v.offsets.to_numpy()).astype(np.int64) for v in whole], axis=0)), 0
                while start < high - low:
                    stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, "right")))
                    p, q = (v.slice(start, stop - start) for v in whole)
                    n_p, n_q = (np.diff(v.offsets.to_numpy()).astype(np.int64) for v in (p, q))
                    width, first = np.repeat(n_q, n_p), np.repeat(np.cumsum(n_q) - n_q, n_p)  # partners of each place of p
                    two = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
                    total += np.bincount(np.repeat(p.flatten().to_numpy(), width).astype(np.int64) * SIDE + q.flatten().to_numpy()[two], minlength=SIDE * SIDE)
                    start = stop
        if cell is not None:
            yield from emptied()

    cells = met.select("x", "y", "p", "q").repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(squares, "ka long, kb long, shared long")
    one, two = (numbered.select(F.col("k").alias(f"k{s}"), F.col("g").alias(s), F.col("n").alias(f"n_{s}")) for s in "ab")
    return cells.join(one, "ka").join(two, "kb").select("a", "b", "shared", "n_a", "n_b")


def jaccard_by_pair(members: DataFrame, group: str, item: str, least: float = 0.0, heavy: int = 1000) -> DataFrame:
    """(a, b, shared, jaccard) of every two groups that share an item, from (group, item) rows, or with ``least`` of
    those alike by that at least, which does not meet the others."""
    m = members.select(F.col(group).alias("g"), F.col(item).alias("i")).distinct()
    if least > 0:
        sets = m.groupBy(F.col("g").alias("key")).agg(F.collect_list("i").alias("items"))
        found = similar_sets(sets, least, heavy, WORDS)
        return found.select("a", "b", "shared", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("jaccard"))
    sized = shared_counts(kept(m.where("g is not null and i is not null"), "members"), m.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    return sized.select("a", "b", "shared", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("jaccard"))


def symmetric(pairs: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """The symmetric matrix (D + D') / 2 in long form, missing cells 0 and the diagonal 0."""
    one = pairs.select(F.col(a).alias("i"), F.col(b).alias("j"), F.col(value).alias("v")).where("i <> j").groupBy("i", "j").agg(F.avg("v").alias("v"))
    turned = one.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("v").alias("w"))
    return one.join(turned, ["i", "j"], "full_outer").select("i", "j", ((F.coalesce("v", F.lit(0.0)) + F.coalesce("w", F.lit(0.0))) / 2).alias("v"))


def pending(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of todo whose keys done lacks: what a resumed run still has to do."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def interval_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", bin_size: int | None = None) -> DataFrame:
    """Pairs of intervals of one key that overlap; touching ends overlap.  Columns of b get the suffix _r.

    With bin_size both sides are dealt by bins as well, so that a key with very many intervals is split; a
    pair is reported in the bin in which the later of its starts lies.
    """
    right = b.select([F.col(c).alias(c if c in keys else f"{c}_r") for c in b.columns])
    over = (F.col(start) <= F.col(f"{end}_r")) & (F.col(end) >= F.col(f"{start}_r"))
    if not bin_size:
        return a.join(right, list(keys)).where(over)
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_size), F.floor(F.col(e) / bin_size)))
    both = a.withColumn("_bin", bins(start, end)).join(right.withColumn("_bin", bins(f"{start}_r", f"{end}_r")), [*keys, "_bin"])
    return both.where(over & (F.col("_bin") == F.floor(F.greatest(start, f"{start}_r") / bin_size))).drop("_bin")


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, anchor: Column) -> DataFrame:
    """Rows within k places of an anchor row in the group's order, with the signed distance offset.

    One pass: each row looks k places either way, so nothing is joined.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    flagged = df.withColumn("_a", F.coalesce(anchor, F.lit(False))).withColumn("_n", F.row_number().over(w))
    near = F.collect_list(F.when(F.col("_a"), F.col("_n"))).over(w.rowsBetween(-k, k))
    seen = flagged.withColumn("_near", near)
    return seen.withColumn("offset", F.explode(F.transform("_near", lambda x: (F.col("_n") - x).cast("int")))).drop("_a", "_n", "_near")
