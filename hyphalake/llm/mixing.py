"""Mixing sources to target weights by a low-discrepancy source schedule.

Every source's documents are put in a keyed shuffled order and cut into blocks of equally many
tokens.  Slot i of the schedule takes the point frac((i + 1/2) * golden ratio), or the van der Corput
point of i, through the cumulative target weights to a source; the rank of the slot among its source's
slots names the block (rank modulo blocks) and the epoch (rank over blocks).  A source's slots end
when its target is met, and what the points leave open of a target follows in closing slots.

Points are integers of 62 bits, so they stay spread at any number of slots.

Scale: a text is read once, to count its words; only (row, key, source, size, hash) is kept and shuffled.  Running token offsets are prefix sums
in two levels, (source, shuffle bucket) totals and then within buckets of about ``bucket_rows`` rows,
and slot ranks likewise by schedule chunk, so that a source with a third of all rows, or a key that all
rows share, never meets in one task.  Sources are a table of one row each; targets are found in one pass
over it.  It is broadcast up to 100,000 sources, which a count checks, and joined beyond.  Three sums
reach the driver.

Defined cases: null source is a source of its own, last in order; null or empty texts have size 0 and
are never taken; an empty table gives an empty mix; repeated rows and keys are separate documents, told
apart by scan order, which shows in ``row`` alone; an input in no fixed order is kept in a table first.

The shuffled order goes by what a row holds (key, source, text), so the same rows give the same mix however
the input is split.  Rows that are equal in all of it are interchangeable and are numbered to be spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hyphalake.llm.common import WORD, Scratch, in_fixed_order, shuffle_partitions


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def content_hash(seed: int, *columns: Column) -> Column:
    """64 bits of what a row holds; nulls are told from values, and one column's from the next one's."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (c.isNull(), F.coalesce(c.cast("string"), F.lit("")))])


def told_apart(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows (row, h, ...) with h made distinct: rows of one hash, which are equal, are numbered and hashed again.

    Numbers are sums over the scan's partitions and places within each, so that no hash gathers its rows.
    """
    parted = rows.withColumn("part", F.shiftright("row", 33))
    each = parted.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    several = each.groupBy("h").agg(F.sum("n").alias("m")).where("m > 1").select("h")
    base = F.sum("n").over(Window.partitionBy("h").orderBy("part")) - F.col("n")
    several = scratch.keep(each.join(several, "h").select("h", "part", base.alias("base")), "repeated")
    place = F.row_number().over(Window.partitionBy("h", "part").orderBy("row")) - 1
    repeated = parted.join(several, ["h", "part"]).withColumn("h", F.xxhash64("h", F.col("base") + place))
    return parted.join(several, ["h", "part"], "left_anti").select(*rows.columns).unionByName(repeated.select(*rows.columns))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_epochs: float = 3.0) -> DataFrame:
    """One row a source: (source, source_size, n_docs, weight, target) from rows (source, size).

    Sources in order of code points, null last, weigh ``weights``, repeating.  Their targets share all
    sizes by weight; none exceeds max_epochs times its source's size, and the excess is shared again by
    weight.  That is water filling: in order of cap over weight a prefix of the sources is capped, so
    one pass over running sums finds it.  The windows see one row a source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", w).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    by = (
        by.withColumn("capped_before", F.coalesce(F.sum("cap").over(up), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(up), F.lit(0.0)))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("capped_before")) / F.col("open_weight"))
        .withColumn("is_capped", F.col("cap") < F.col("level") * F.col("weight"))
    )
    level = F.min(F.when(~F.col("is_capped"), F.struct(F.col("capped_before"), F.col("level")))).over(whole)["level"]
    return by.withColumn("target", F.when(F.col("is_capped"), F.col("cap")).otherwise(F.coalesce(level, F.lit(0.0)) * F.col("weight"))).select("source", "source_size", "n_docs", "weight", "target")


#: Points are fractions of 2^POINT_BITS, so they keep their spread however many slots there are.
POINT_BITS = 62
#: (sqrt(5) - 1) / 2 in these units.
GOLDEN = (isqrt(5 << 2 * POINT_BITS) - (1 << POINT_BITS)) >> 1
#: Sources up to which their table is broadcast; beyond, it is joined.
BROADCAST_SOURCES = 100_000


def golden_points(i: Column) -> Column:
    """frac((i + 1/2) * GOLDEN), for i below 2^46: 16 bits of the ratio at a time, so that no product overflows."""
    keep = lambda c: c.bitwiseAND(F.lit((1 << POINT_BITS) - 1))
    out = F.lit(GOLDEN >> 1)
    for at in range(0, POINT_BITS, 16):
        limb = (GOLDEN >> at) & 0xFFFF
        out = keep(out + F.shiftleft((i * F.lit(limb)).bitwiseAND(F.lit((1 << (POINT_BITS - at)) - 1)), at))
    return out


def van_der_corput(i: Column) -> Column:
    """The bits of i, mirrored at the binary point."""
    return F.conv(F.reverse(F.lpad(F.bin(i), POINT_BITS, "0")), 2, 10).cast("long")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    max_epochs: float = 3.0,
    block_tokens: int = 1024,
    points: str = "golden",
    seed: int = 17,
    bucket_rows: int = 4096,
    chunk_slots: int = 65536,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, schedule, uses) of the mix.

    documents: row (by scan order), key, source, size, source_size, target, taken (tokens the mix takes,
    repeats counted), first_slot and last_slot that read it, slots (of the block it begins in, by epoch).
    schedule: slot, sid, block, epoch, tokens - the training order.
    uses: row, key, sid, block, start, tokens - which tokens of a document lie in which block.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    docs = docs if in_fixed_order(docs) else scratch.keep(docs, "input")
    sized = scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), content_hash(seed, F.col(key), F.col(source).cast("string"), F.col(text)).alias("h")), "sizes")
    targets = source_targets(sized, weights, max_epochs)
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = (
        targets.withColumn("sid", F.row_number().over(order))
        .withColumn("quota", F.round("target").cast("long"))
        .withColumn("n_blocks", F.ceil(F.col("source_size") / block_tokens).cast("long"))
        .withColumn("n_buckets", F.ceil(F.col("n_docs") / bucket_rows).cast("long"))
    )
    # The last block of a pass over the source is short, so that passes repeat the same blocks.
    per = per.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0)))
    per = per.withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
    per = per.withColumn("n_slots", F.col("passes") * F.col("n_blocks") + F.ceil(F.col("rest") / block_tokens).cast("long"))
    per = per.withColumn("upto", F.sum("quota").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    per = scratch.keep(per, "sources")
    known = per.agg(F.count(F.lit(1)).alias("n"), F.sum("n_slots").alias("slots"), F.sum("quota").alias("total")).first()
    joined = F.broadcast if known.n <= BROADCAST_SOURCES else (lambda df: df)
    per_source = joined(per)

    # Shuffled order and equal-token blocks.
    docs_in = told_apart(sized.where("size > 0"), scratch).join(per_source.select(F.col("source").alias("_source"), "sid", "n_buckets", "source_size"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    docs_in = docs_in.withColumn("bucket", F.floor(F.shiftrightunsigned("h", 11) / F.lit(float(2**53)) * F.col("n_buckets")).cast("long"))
    totals = docs_in.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
    totals = totals.withColumn("base", F.sum("bucket_size").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("bucket_size")).select("sid", "bucket", "base")
    docs_in = docs_in.join(totals, ["sid", "bucket"])
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, 0)
    docs_in = docs_in.withColumn("at", F.col("base") + F.sum("size").over(inside) - F.col("size"))
    pieces = docs_in.select("sid", "row", "doc_id", "size", "at", F.explode(F.sequence(F.expr(f"at div {block_tokens}"), F.expr(f"(at + size - 1) div {block_tokens}"))).alias("block"))
    lo = F.greatest(F.col("at"), F.col("block") * block_tokens)
    hi = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_tokens)
    uses = pieces.select("sid", "block", "row", "doc_id", (lo - F.col("at")).alias("start"), (hi - lo).alias("tokens"), (lo - F.col("block") * block_tokens).alias("in_block"))

    schedule = source_schedule(spark, per, known.n, known.slots or 0, known.total or 0, points, chunk_slots)
    schedule = schedule.join(per_source.select("sid", "n_blocks", "rest", "passes", "source_size"), "sid")
    k, e = F.col("rank") % F.col("n_blocks"), F.expr("rank div n_blocks")
    full = F.least(F.lit(block_tokens), F.col("source_size") - k * block_tokens)
    schedule = schedule.select("slot", "sid", k.alias("block"), e.alias("epoch"), F.when(e < F.col("passes"), full).otherwise(F.least(full, F.col("rest") - k * block_tokens)).alias("tokens"))

    # A block's slots differ only in how far the closing one reads into it; there is one an epoch.
    by_block = schedule.groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "slot", "tokens"))).alias("reads"))
    reach = F.aggregate("reads", F.lit(0).cast("long"), lambda acc, r: acc + F.greatest(F.lit(0), F.least(r["tokens"] - F.col("in_block"), F.col("tokens"))))
    seen = F.transform(F.filter("reads", lambda r: r["tokens"] > F.col("in_block")), lambda r: r["slot"])
    read = uses.join(by_block, ["sid", "block"]).select("row", "start", reach.alias("got"), seen.alias("seen"))
    read = read.groupBy("row").agg(F.sum("got").alias("taken"), F.min(F.array_min("seen")).alias("first_slot"), F.max(F.array_max("seen")).alias("last_slot"), F.max(F.when(F.col("start") == 0, F.col("seen"))).alias("slots"))
    placed = sized.join(read, "row", "left")
    none = F.array().cast("array<bigint>")
    out = placed.join(per_source.select(F.col("source").alias("_source"), "source_size", "target"), placed["source"].eqNullSafe(F.col("_source")))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", "last_slot", F.coalesce("slots", none).alias("slots")), schedule, uses


def source_schedule(spark: SparkSession, per: DataFrame, n_sources: int, n: int, total: int, points: str = "golden", chunk_slots: int = 65536) -> DataFrame:
    """(slot, sid, rank): the source of each slot and the slot's rank among its source's slots.

    per has one row a source (sid, quota, n_slots, upto: the quotas up to it); the quotas are the shares.
    Slots beyond a source's n_slots are given up; what a source then lacks follows in closing slots after
    the last point.  A slot finds its source by an equi-join on the leading bits of its point, at most a
    few sources a value.
    """
    shift = POINT_BITS - max(12, min(40, (n_sources or 1).bit_length() + 2))
    edge = lambda c: F.when(c >= total, F.lit(1 << POINT_BITS)).otherwise(F.floor(c.cast("double") / F.lit(float(max(total, 1))) * F.lit(float(1 << 53))).cast("long") * F.lit(1 << (POINT_BITS - 53)))
    spans = per.where("quota > 0").select("sid", edge(F.col("upto") - F.col("quota")).alias("lo"), edge(F.col("upto")).alias("hi")).where("lo < hi")
    spans = spans.select("sid", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("lead"))
    i = F.col("id")
    u = van_der_corput(i) if points == "van_der_corput" else golden_points(i)
    at = spark.range(n).withColumn("u", u).withColumn("lead", F.shiftright("u", shift))
    few = n_sources <= BROADCAST_SOURCES
    at = at.join(F.broadcast(spans) if few else spans, "lead").where("lo <= u and u < hi").select("id", "sid", F.expr(f"id div {chunk_slots}").alias("chunk"))
    counts = at.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).select("sid", "chunk", "base")
    ranked = at.join(before, ["sid", "chunk"]).withColumn("rank", F.col("base") + F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("id")) - 1)
    slots = per.select("sid", "n_slots")
    drawn = ranked.join(F.broadcast(slots) if few else slots, "sid").where("rank < n_slots").select(F.col("id").alias("slot"), "sid", "rank")
    have = counts.groupBy("sid").agg(F.sum("n").alias("have"))
    left = slots.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < n_slots")
    closing = left.select("sid", F.explode(F.sequence("have", F.col("n_slots") - 1)).alias("rank"))
    # Few a source: the points' shares miss the quotas by their discrepancy only.
    closing = closing.select((F.lit(n - 1) + F.row_number().over(Window.orderBy("rank", "sid"))).alias("slot"), "sid", "rank")
    return drawn.unionByName(closing)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, in the columns of docs and in the order of the schedule.

    A document that the mix takes for part of a pass counts as taken when at least half of its words
    are, so texts stay whole and every source stays within one document of its target.  A copy stands
    where the schedule reads the block in which the document begins; partitions are ranges of slots.
    """
    spark = docs.sparkSession
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    own = own if in_fixed_order(docs) else Scratch(spark, "mixing").keep(own, "input")
    names = {c: at[options.pop(c, d)] for c, d in (("key", "doc_id"), ("source", "source"), ("text", "text"))}
    plan, _, _ = mix(own, **names, **options)
    times = F.when(F.col("size") > 0, F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))).otherwise(0).cast("int")
    copies = plan.select("row", "slots", "last_slot", times.alias("n")).where("n > 0").select("row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"), "slots", "last_slot")
    copies = copies.select("row", F.coalesce(F.get("slots", F.col("k")), "last_slot").alias("slot"))
    copies = Scratch(spark, "mixing").keep(copies, "copies")
    parts = shuffle_partitions(spark)
    end = (copies.agg(F.max("slot")).first()[0] or 0) + 1
    joined = own.withColumn("row", F.monotonically_increasing_id()).join(copies, "row")
    dealt = joined.withColumn("part", F.expr(f"cast(slot * {parts} div {end} as int)")).repartitionById(parts, "part").sortWithinPartitions("slot", "row")
    return dealt.select(*[F.col(f"own_{k}").alias(c) for k, c in enumerate(docs.columns)])
