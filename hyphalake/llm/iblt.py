"""Document fingerprints by an invertible Bloom lookup sketch of paragraphs.

A text's paragraphs are its lines; a line beyond ``line_chars`` is divided at sentence ends, a
sentence beyond it to its words, and a text
shorter than ``short_chars`` altogether to its words, as one edit would else change all of it.  Where
only one version of a pair is that short, ``by_pair`` compares both by words.  Each
paragraph's 64-bit digest goes to one cell in each of three sub-tables; a cell holds a count and sums
of the digest's halves and of a check hash.  Cells of two versions subtract, and peeling (take a cell
whose content is some multiple of one digest that its check hash confirms, take it out of its three
cells, go on) recovers exactly the paragraphs that differ.  Cells are numbered by the low bits of the
digest's parts, so a sketch of 2^k cells a sub-table folds to any smaller one.  The fingerprint of a
text is its sketch of 24 cells.  Two fingerprints are subtracted and peeled; where that fails, the cells
left tell about how many paragraphs differ, and both texts are sketched again at a size for that many,
then four times as large.  What is left after that, or would need more than 3 * 2^max_level cells, is
counted exactly, digest by digest.  Likeness is shared over all paragraphs, (n - d) / (n + d) for n
paragraphs in both versions together and d differing ones, so it is exact however large the sketch was.

All of it is DataFrame functions: no Python runs on the executors.

Scale: texts are shuffled once, by ranges of the key whose bounds (a few a partition) the driver
knows; a bound's own row goes to both neighbouring ranges, so the next document is always in reach.
The paragraph digests are written where their text lies, into a table bucketed by range, and all
sketches are summed and peeled there without another shuffle.  Retries read the pairs that failed only.

Defined cases: null text counts as empty; empty texts have no paragraphs and likeness 1 to each other;
a null key is last in descending order; repeated keys follow one another in order of text; a single
document is its own next; an empty table gives an empty table; counts of repeated paragraphs count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hyphalake.llm.common import Scratch, shuffle_partitions

SUMS = ("c", "hi", "lo", "chk")
NO_KEY = -(2**63)


def paragraph_digests(text: Column, line_chars: int = 400, short_chars: int = 400) -> Column:
    """array<long>: XXH64 of every paragraph that holds more than blanks."""
    lines = F.split(text, "\n")
    parts = F.flatten(F.transform(lines, lambda x: F.when(F.length(x) > line_chars, F.split(x, r"(?<=[.!?])\s+")).otherwise(F.array(x))))
    parts = F.flatten(F.transform(parts, lambda x: F.when(F.length(x) > line_chars, F.split(x, r"[\x20\x09-\x0D]+")).otherwise(F.array(x))))
    parts = F.when(F.length(text) < short_chars, F.split(text, r"[\x20\x09-\x0D]+")).otherwise(parts)
    return F.transform(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x))


def bounds_below(bounds: Sequence[int], key: Column) -> Column:
    """How many of the sorted bounds lie below the key, looked up in two steps of about their root each."""
    step = max(1, int(len(bounds) ** 0.5))
    less = lambda c: F.size(F.filter(c, lambda b: b < key))
    block = less(F.array(*map(F.lit, bounds[step - 1 :: step])) if len(bounds) >= step else F.array().cast("array<bigint>"))
    return (block * step + less(F.slice(F.array(*map(F.lit, bounds)), block * step + 1, F.lit(step)))).cast("int")


def bucket_labels(spark: SparkSession, n: int) -> list[int]:
    """For each of n buckets a number that Spark's hash partitioning puts there."""
    found: dict[int, int] = {}
    start = 0
    while len(found) < n:
        for r in spark.range(start, start + 16 * n).select("id", F.expr(f"pmod(hash(id), {n})").alias("b")).collect():
            found.setdefault(r.b, r.id)
        start += 16 * n
    return [found[b] for b in range(n)]


def with_next(docs: DataFrame, key: str, text: str, ranges: int) -> DataFrame:
    """(range, rid, doc_id, text, next_text): next is the following row in descending key order, after the last the first.

    Ranges of keys are numbered so that each is one of as many hash partitions.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("k", F.coalesce("doc_id", F.lit(NO_KEY)))
    # Bounds are keys that occur; a few for each shuffle partition, whatever the number of rows.
    seen = rows.agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)] or [1.0], 50 * ranges).alias("b"), F.max("k").alias("top")).first()
    bounds = sorted({*(seen.b or []), *([seen.top] if seen.top is not None else [])}) or [0]
    # A row's range is the number of bounds below its key; a bound's row also ends the range above it, the top one the lowest.
    every, own = F.array(*map(F.lit, bounds)), bounds_below(bounds, F.col("k"))
    after = F.when(own + 1 == len(bounds), F.lit(0)).otherwise(own + 1)
    edge = F.coalesce(F.get(every, own) == F.col("k"), F.lit(False))
    dealt = rows.withColumn("range", F.explode(F.when(edge, F.array(F.struct(own.alias("at"), F.lit(0).alias("guest")), F.struct(after.alias("at"), F.lit(1).alias("guest")))).otherwise(F.array(F.struct(own.alias("at"), F.lit(0).alias("guest")))))).select("doc_id", "text", "k", "range.*")
    labels = F.array(*[F.lit(x).cast("long") for x in bucket_labels(docs.sparkSession, ranges)])
    dealt = dealt.select("doc_id", "text", "k", "guest", F.get(labels, F.col("at")).alias("range")).repartition(ranges, "range")
    order = Window.partitionBy("range").orderBy("guest", F.col("k").desc(), "text")
    placed = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("rn", F.row_number().over(order))
    return placed.where("guest = 0").select("range", (F.col("range") * F.lit(2**36) + F.col("rn")).alias("rid"), "doc_id", "text", F.coalesce("next_text", "text").alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the code points replaced by as many of the next text's first."""
    n = F.length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(next_text, F.lit(1), cut))


def _cell(level: str, digest: str, table: str) -> str:
    """SQL for a digest's cell in a sub-table of 2^level cells."""
    return f"((shiftrightunsigned({digest}, 21 * {table}) & (shiftleft(1L, {level}) - 1)) * 3 + {table})"


def _check(hi: str, lo: str) -> str:
    return f"(xxhash64({hi}, {lo}, 7) & 4294967295L)"


def _digest_cells(flat: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., cell, s, hi, lo, chk): the three cells of each digest d; rows have a level and the columns named."""
    flat = flat.select(*by, "d", F.expr("shiftrightunsigned(d, 32)").alias("hi"), F.expr("d & 4294967295L").alias("lo"))
    # Indices of a constant array are exploded instead of structs, so rows stay primitive.
    flat = flat.select(*by, "d", "hi", "lo", F.expr(_check("hi", "lo")).alias("chk"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("t"))
    return flat.select(*by, F.expr(_cell("level", "d", "t")).alias("cell"), F.lit(1).cast("long").alias("c"), "hi", "lo", "chk")


def sketches(pairs: DataFrame, arrays: Sequence[str], level: int) -> DataFrame:
    """(rid, level, cell, and the sums of each array's sketch as v0_c, v0_hi, ...): sketches of 2^level cells a sub-table."""
    version, before = F.lit(0), F.lit(0)
    for k in range(len(arrays) - 1):
        before = before + F.col(f"n{k}")
        version = version + (F.col("at") >= before).cast("int")
    flat = pairs.select("range", "rid", *[F.size(c).alias(f"n{k}") for k, c in enumerate(arrays)], F.posexplode(F.concat(*arrays)).alias("at", "d"))
    cells = _digest_cells(flat.select("range", "rid", F.lit(level).alias("level"), version.alias("v"), "d"), ["range", "rid", "level", "v"])
    return cells.groupBy("range", "rid", "level", "cell").agg(*[F.sum(F.when(F.col("v") == v, F.col(s)).otherwise(0)).alias(f"v{v}_{s}") for v in range(len(arrays)) for s in SUMS])


def compared(pairs: DataFrame) -> DataFrame:
    """(rid, kind, level, x, y): what a pair compares with its edited text (kind 0, where l0 is a level) and with the next (kind 1, l1)."""
    one = lambda k, level, x, y: F.struct(F.lit(k).alias("kind"), F.col(level).alias("level"), x.alias("x"), y.alias("y"))
    words = lambda flag, own: F.when(F.col(flag), F.col("aw")).otherwise(F.col(own))
    both = F.array(one(0, "l0", words("se", "a"), F.coalesce("ew", "e")), one(1, "l1", words("sn", "a"), F.col("n")))
    return pairs.select("range", "rid", F.explode(F.filter(both, lambda p: p["level"].isNotNull())).alias("p")).select("range", "rid", "p.*")


def _signed(todo: DataFrame) -> DataFrame:
    """(rid, kind, level, s, d): each paragraph of a pair's two versions; s is 1 in the first and -1 in the second."""
    flat = todo.select("range", "rid", "kind", "level", F.size("x").alias("nx"), F.posexplode(F.concat("x", "y")).alias("at", "d"))
    return flat.select("range", "rid", "kind", "level", F.when(F.col("at") < F.col("nx"), 1).otherwise(-1).cast("long").alias("s"), "d")


def differences(todo: DataFrame) -> DataFrame:
    """(rid, kind, level, cell, sums): the first version's sketch minus the second's, cell by cell.

    Sketches are linear, so the subtraction of two is one signed sum.
    """
    cells = _digest_cells(_signed(todo), ["range", "rid", "kind", "level", "s"])
    out = cells.groupBy("range", "rid", "kind", "level", "cell").agg(*[F.sum(F.col(s) * F.col("s")).alias(s) for s in SUMS])
    return out.where("c <> 0 or hi <> 0 or lo <> 0 or chk <> 0")


def peel(cells: DataFrame, rounds: int) -> DataFrame:
    """(rid, kind, level, left, found, guess): cells that are not empty in the end, the differing paragraphs recovered,
    and a guess at how many are left.

    A cell's sums of uniform 32-bit numbers, each with the sign of its version and less their mean, have a
    square that grows by 2^64 / 12 a paragraph; cells, sub-tables and the three numbers are averaged.
    cells: rid, level, kind, cell, c, hi, lo, chk.  A round peels one sub-table, in which a digest has
    one cell only, so nothing is taken out twice: a pure cell's row becomes itself, its three negatives
    and a tally, and cells are summed again.  Tallies ride along in a cell numbered -1.
    """
    now = cells.withColumn("found", F.lit(0).cast("long"))
    for r in range(rounds):
        here = now.select("*", F.expr("abs(c)").alias("n"), F.expr("cast(signum(c) as bigint)").alias("s"), *[F.expr(f"{x} * cast(signum(c) as bigint) div nullif(abs(c), 0)").alias(f"d{x}") for x in ("hi", "lo")])
        # The content must be a multiple of one digest that its check confirms, and name the cell it is in.
        here = here.select("*", F.expr("shiftleft(dhi, 32) | dlo").alias("d"), F.expr(f"cell >= 0 and cell % 3 = {r % 3} and n > 0 and dhi >= 0 and dlo >= 0 and dhi * n * s = hi and dlo * n * s = lo and {_check('dhi', 'dlo')} * n * s = chk").alias("ok"))
        pure = F.expr(f"coalesce(ok and {_cell('level', 'd', str(r % 3))} = cell, false)")
        rows = here.select("range", "rid", "level", "kind", "cell", *SUMS, "found", "n", "d", F.explode(F.when(pure, F.array(*[F.lit(i) for i in range(5)])).otherwise(F.array(F.lit(0)))).alias("i"))
        cell = F.expr(f"case i when 0 then cell when 4 then -1L else {_cell('level', 'd', '(i - 1)')} end")
        now = rows.select("range", "rid", "level", "kind", cell.alias("cell"), *[F.expr(f"case i when 0 then {x} when 4 then 0L else -{x} end").alias(x) for x in SUMS], F.expr("case i when 0 then found when 4 then n else 0L end").alias("found"))
        now = now.groupBy("range", "rid", "level", "kind", "cell").agg(*[F.sum(x).alias(x) for x in SUMS], F.sum("found").alias("found"))
        now = now.where("cell < 0 or c <> 0 or hi <> 0 or lo <> 0 or chk <> 0")
    spread = sum(((F.col(x).cast("double") - F.col("c") * float(2**31)) ** 2 for x in SUMS[1:]), F.lit(0.0)) * (12 / 2**64 / 9)
    return now.groupBy("range", "rid", "level", "kind").agg(F.count(F.when(F.col("cell") >= 0, 1)).alias("left"), F.sum("found").alias("found"), F.sum(F.when(F.col("cell") >= 0, spread)).alias("guess"))


def exact_differences(todo: DataFrame) -> DataFrame:
    """(rid, kind, found): the differing paragraphs by a grouped count of digests, for what no sketch peels."""
    net = _signed(todo).groupBy("range", "rid", "kind", "d").agg(F.sum("s").alias("s"))
    return net.groupBy("range", "rid", "kind").agg(F.sum(F.abs("s")).alias("found"))


@contextmanager
def partitioned_by_some(spark: SparkSession) -> Iterator[None]:
    """Lets joins keep a partitioning by some of their keys: rows meet by range and row, and are dealt by range."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fingerprint_report(docs: DataFrame, key: str = "doc_id", text: str = "text", base_level: int = 3, rounds: int = 6, line_chars: int = 400, max_level: int = 20, short_chars: int = 400, by_pair: bool = False, max_retries: int = 3) -> DataFrame:
    """One row a row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_paragraphs, edited_differ, next_differ, edited_level, next_level.

    fingerprint lists the cells of the sketch of 2^base_level cells a sub-table that are not empty, as
    cell:count:sums in hex.  edited_level and next_level tell the size of the sketches whose subtraction
    gave the answer: base_level where the fingerprints themselves did, null where digests were counted.
    With by_pair, likeness and differences of two versions of which one alone is short are taken over the
    words of both.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "iblt")
    n = shuffle_partitions(spark)
    buckets = 4 * n  # a task sums some cells for each byte of digests, so it takes less than a shuffle partition
    rows = with_next(docs, key, text, buckets)
    made = edited(F.col("text"), F.col("next_text"))
    rows = rows.select("range", "rid", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", "next_text", made.alias("edit"))
    short = {c: F.length(c) < short_chars for c in ("text", "edit", "next_text")}
    rows = rows.select("*", (F.lit(by_pair) & (short["text"] != short["edit"])).alias("se"), (F.lit(by_pair) & (short["text"] != short["next_text"])).alias("sn"))
    own = lambda c: paragraph_digests(F.col(c), line_chars, short_chars)
    words = lambda c: paragraph_digests(F.col(c), line_chars, 2**31 - 1)
    rows = rows.select("range", "rid", "doc_id", "n_chars", F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"), "se", "sn", own("text").alias("a"), own("edit").alias("e"), F.when(F.col("sn"), words("next_text")).otherwise(own("next_text")).alias("n"), F.when(F.col("se") | F.col("sn"), words("text")).alias("aw"), F.when(F.col("se"), words("edit")).alias("ew"))
    pairs = scratch.keep_bucketed(rows, "digests", buckets, "range", dealt=True)

    # The fingerprints: the base sketch of either version.
    base = sketches(pairs, ["a", "e"], base_level)

    def shown(v: int) -> Column:
        full = F.when(F.col(f"v{v}_c") > 0, F.struct(F.col("cell"), F.concat_ws(":", *[F.lower(F.hex(F.col(c))) for c in ("cell", *(f"v{v}_{s}" for s in SUMS))]).alias("t")))
        return F.array_join(F.transform(F.array_sort(F.collect_list(full)), lambda x: x["t"]), " ")

    prints = base.groupBy("range", "rid").agg(shown(0).alias("fingerprint"), shown(1).alias("edited_fingerprint"))

    # Fingerprints are subtracted and peeled; a pair that fails is tried again at the size its own cells ask for.
    todo = compared(pairs.withColumns({"l0": F.lit(base_level), "l1": F.lit(base_level)}))
    results = None
    for attempt in range(max_retries + 1):
        with partitioned_by_some(spark):
            out = scratch.keep(peel(differences(todo), rounds), f"peeled-{attempt}")
        good = out.where("left = 0").select("range", "rid", "kind", "found", "level")
        results = good if results is None else results.unionByName(good)
        wanted = F.ceil(F.log2(1.5 * (F.col("guess") + F.col("found")) + 1)).cast("int") if attempt == 0 else F.col("level") + 2
        failed = out.where("left > 0").select("range", "rid", "kind", F.greatest(F.col("level") + 1, wanted).alias("level"))
        if not failed.head(1):
            break
        per = failed.groupBy("range", "rid").agg(*[F.max(F.when(F.col("kind") == k, F.col("level"))).alias(f"l{k}") for k in (0, 1)])
        again = compared(pairs.join(per.hint("shuffle_hash"), ["range", "rid"]))  # built from the small side, so arrays are not sorted
        last = attempt == max_retries
        over = again if last else again.where(F.col("level") > max_level)
        with partitioned_by_some(spark):
            counted = scratch.keep(exact_differences(over), f"counted-{attempt}")
        results = results.unionByName(counted.withColumn("level", F.lit(None).cast("int")))
        todo = again.where(F.col("level") <= max_level)
    differ = results.groupBy("range", "rid").agg(*[F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{s}_{v}") for k, v in enumerate("en") for c, s in (("found", "d"), ("level", "at"))])
    size = lambda v: F.when(F.col(f"s{v}"), F.size("aw")).otherwise(F.size("a")) + F.size(F.coalesce("ew", "e") if v == "e" else F.col("n"))
    heads = pairs.select("range", "rid", "doc_id", "n_chars", "edited_sha256", F.size("a").alias("n_paragraphs"), size("e").alias("both_e"), size("n").alias("both_n"))
    joined = heads.join(prints, ["range", "rid"], "left").join(differ, ["range", "rid"], "left")

    def likeness(v: str) -> Column:
        both, d = F.col(f"both_{v}"), F.coalesce(F.col(f"d_{v}"), F.lit(0))
        return F.when(both == 0, F.lit(1.0)).otherwise((both - d) / (both + d))

    return joined.select("doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"), F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"), likeness("e").alias("near_edited"), likeness("n").alias("near_next"), "n_paragraphs", F.coalesce("d_e", F.lit(0)).alias("edited_differ"), F.coalesce("d_n", F.lit(0)).alias("next_differ"), F.col("at_e").alias("edited_level"), F.col("at_n").alias("next_level"))
