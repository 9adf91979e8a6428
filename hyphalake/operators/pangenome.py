"""Presence, copy number, frequency classes, consensus annotation and rarefaction of features over genomes.

Everything stays long and sparse, (feature, genome) rows; a wide matrix is made only at a sink.  The
default names are og and genome; all operators take column names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hyphalake.functions.text import split_terms
from hyphalake.operators.relational import best_row
from hyphalake.sources.shared import kept


def presence(long: DataFrame, feature: str = "og", genome: str = "genome", by: Sequence[str] = ()) -> DataFrame:
    return long.where(F.col(feature).isNotNull() & F.col(genome).isNotNull()).select(*by, feature, genome).distinct()


def copy_number(long: DataFrame, feature: str = "og", genome: str = "genome", by: Sequence[str] = ()) -> DataFrame:
    return long.groupBy(*by, feature, genome).agg(F.count(F.lit(1)).alias("copies"))


def wide(long: DataFrame, feature: str, genome: str, genomes: Sequence, value: Column | None = None) -> DataFrame:
    """The matrix with a column a genome; for sinks, its width is the number of genomes given."""
    return long.groupBy(feature).pivot(genome, list(genomes)).agg(value if value is not None else F.lit(1)).na.fill(0)


def wide_presence(pav: DataFrame, feature: str, genome: str, genomes: Sequence) -> DataFrame:
    """wide of presence rows for very many genomes: rows are filled in tasks, so that the plan has no expression a column."""
    at = {str(g): k for k, g in enumerate(genomes)}
    own = pav.groupBy(feature).agg(F.collect_set(F.col(genome).cast("string")).alias("has"))
    schema = StructType([own.schema[feature], *[StructField(str(g), IntegerType(), False) for g in genomes]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                cells = np.zeros(len(at), np.int32)
                cells[[at[g] for g in b.column(1)[k].as_py() if g in at]] = 1
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), *[pa.array(cells[c : c + 1]) for c in range(len(cells))]], [feature, *at])

    return own.mapInArrow(run, schema)


def frequency(pav: DataFrame, feature: str = "og", by: Sequence[str] = ()) -> DataFrame:
    """Number of genomes that have each feature, from presence rows."""
    return pav.groupBy(*by, feature).agg(F.count(F.lit(1)).alias("n_genomes"))


def frequency_histogram(freq: DataFrame, n_genomes: int) -> DataFrame:
    every = freq.sparkSession.range(1, n_genomes + 1).select(F.col("id").alias("n_genomes"))
    return every.join(freq.groupBy("n_genomes").agg(F.count(F.lit(1)).alias("n_features")), "n_genomes", "left").na.fill(0)


def pangenome_class(n: Column, core_n: Column | int, rare_n: Column | int) -> Column:
    return F.when(n >= core_n, "Core").when(n <= rare_n, "Rare").otherwise("Accessory")


def _two_powers(x: np.ndarray, n: int, p: np.ndarray) -> np.ndarray:
    return p[0] * x ** -p[1] + p[2] * (n + 1 - x) ** -p[3]


def fit_two_powers(counts: np.ndarray, steps: int = 400) -> np.ndarray | None:
    """c1, a1, c2, a2 of c1 x^-a1 + c2 (n+1-x)^-a2 fitted to log(1 + counts) by damped least squares in bounds."""
    n = len(counts)
    x, y = np.arange(1, n + 1, dtype=float), np.log1p(counts)
    low, high = np.array([0, 0.01, 0, 0.01]), np.array([np.inf, 10, np.inf, 10])
    p, damp = np.array([max(counts[0], 1.0), 1.0, max(counts[-1], 1.0), 1.0]), 1e-2
    loss = lambda q: float(((np.log1p(_two_powers(x, n, q)) - y) ** 2).sum())
    now = loss(p)
    for _ in range(steps):
        f = 1 + _two_powers(x, n, p)
        left, right = x ** -p[1], (n + 1 - x) ** -p[3]
        jac = np.column_stack((left, -p[0] * left * np.log(x), right, -p[2] * right * np.log(n + 1 - x))) / f[:, None]
        res = np.log(f) - y
        h = jac.T @ jac
        try:
            q = np.clip(p - np.linalg.solve(h + damp * (np.diag(np.diag(h)) + 1e-9 * np.eye(4)), jac.T @ res), low, high)
        except np.linalg.LinAlgError:
            return None
        new = loss(q)
        if not np.isfinite(new) or new >= now:
            damp *= 4
            if damp > 1e12:
                break
            continue
        done = now - new < 1e-12 * max(1.0, now)
        p, now, damp = q, new, damp / 3
        if done:
            break
    return p if np.isfinite(now) else None


def class_thresholds(counts: Sequence[int], travel: float = 0.9) -> tuple[int, int]:
    """(core_n, rare_n) from the histogram of feature frequencies 1..N.

    The least point of the fitted curve lies between; each threshold is ``travel`` of the way from there
    to its end, rounded half to even.  Without a fit the least count of the interior is taken.
    """
    c = np.asarray(counts, float)
    n = len(c)
    p = fit_two_powers(c)
    if p is not None:
        grid = np.linspace(1.0, float(n), 2000)
        low = float(grid[int(np.argmin(_two_powers(grid, n, p)))])
    else:
        a, b = max(1, int(0.05 * n)), max(2, int(0.95 * n))
        low = float(a + 1 + int(np.argmin(c[a:b])))
    core, rare = int(np.round(low + travel * (n - low))), int(np.round(low - travel * (low - 1)))
    return min(max(core, 1), n), max(1, min(rare, n))


def composition(classes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Features by class and their share in per cent."""
    n = classes.groupBy(*by, "pangenome_class").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def consensus(annot: DataFrame, key: Sequence[str], columns: Sequence[str], min_fraction: float = 0.5, separators: str = "[;,|]") -> DataFrame:
    """(key, layer, term, support, n_proteins): the term that most proteins of a group carry, for every layer at once.

    A term counts once a protein.  If no term reaches min_fraction of the proteins that are annotated in
    the layer, the commonest is taken all the same; ties go to the first term in order.
    """
    layers = F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.array_distinct(split_terms(F.col(c), separators)).alias("terms")) for c in columns]))
    cells = annot.select(*key, layers.alias("x")).select(*key, "x.layer", "x.terms").where(F.size("terms") > 0)
    counted = cells.select(*key, "layer", F.explode("terms").alias("term")).groupBy(*key, "layer", "term").agg(F.count(F.lit(1)).alias("support"))
    top = best_row(counted, [*key, "layer"], [F.desc("support"), F.col("term")])
    totals = cells.groupBy(*key, "layer").agg(F.count(F.lit(1)).alias("n_proteins"))
    joined = top.join(totals, [*key, "layer"])
    return joined.withColumn("is_majority", F.col("support") >= F.col("n_proteins") * min_fraction)


def consensus_wide(terms: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return terms.groupBy(*key).pivot("layer", list(columns)).agg(F.first("term"))


def private_features(pav: DataFrame, excluded: DataFrame, feature: str = "og", genome: str = "genome") -> DataFrame:
    """Features that only excluded genomes have."""
    marked = pav.join(F.broadcast(excluded.select(genome).distinct().withColumn("_x", F.lit(True))), genome, "left")
    return marked.groupBy(feature).agg(F.bool_and(F.coalesce("_x", F.lit(False))).alias("_all")).where("_all").select(feature)


def genome_orders(genomes: DataFrame, genome: str, n_perm: int, seed: str = "0") -> DataFrame:
    """(perm, genome, pos): a shuffled order of the genomes for each permutation, the same on every run."""
    each = genomes.select(genome).distinct().withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
    w = Window.partitionBy("perm").orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col("perm").cast("string"), F.col(genome).cast("string"))), genome)
    return each.withColumn("pos", F.row_number().over(w))


#: Cells (features x genomes) that a task of a rarefaction counts for its orders, about.
CELLS = 4_000_000


def rarefaction(pav: DataFrame, n_perm: int, feature: str = "og", genome: str = "genome", seed: str = "0", places: int = 10_000_000) -> DataFrame:
    """(perm, n, pan, core) for n = 1..N genomes in each order of genome_orders.

    A feature is in the pan of n genomes if its first place is at most n, and in their core if the first place
    without it is beyond n.  Each order is made once, by a task of its own, as the place of every genome.  A
    feature's genomes are gathered to one row, and features are dealt to chunks of about CELLS cells; chunk by
    chunk they meet the orders in blocks of ``places`` numbers (genomes x orders) at most.  A task counts first
    places as minima over a feature's own genomes, and looks further only at features that the first genome has,
    so it takes time in proportion to cells x orders.  Counts are added up order by order.
    """
    spark = pav.sparkSession
    names = [r["g"] for r in pav.select(F.col(genome)).distinct().orderBy(genome).select(F.col(genome).cast("string").alias("g")).collect()]
    total = len(names)
    per = max(1, min(n_perm, places // max(total, 1)))
    label = dict(pav.dtypes)[genome]
    numbered = spark.createDataFrame([(g, k) for k, g in enumerate(names)], "_g string, _i int").select(F.col("_g").cast(label).alias(genome), "_i")

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for perm in b.column(0).to_pylist():
                digest = [hashlib.md5(f"{seed}|{perm}|{g}".encode()).digest() for g in names]
                place = np.empty(total, np.int32)
                place[sorted(range(total), key=digest.__getitem__)] = np.arange(1, total + 1)
                yield pa.RecordBatch.from_arrays([pa.array([perm], pa.int32()), pa.array([place.tobytes()], pa.binary())], ["perm", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, perms, place, pan, core = None, [], [], None, None

        def counted() -> Iterator[pa.RecordBatch]:
            for perm, p, c in zip(perms, pan if pan is not None else [], core if core is not None else []):
                yield pa.RecordBatch.from_arrays([pa.array([perm], pa.int32()), *[pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (p, c)]], ["perm", "pan", "core"])

        for b in batches:
            key = np.stack([b.column(k).to_numpy() for k in (0, 1)])
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0).any(axis=0)) + 1).tolist(), len(b)]
            for x, y in zip(cuts, cuts[1:]):
                if y > x and (key[0, x], key[1, x]) != at:
                    yield from counted()
                    at, perms, place, pan, core = (key[0, x], key[1, x]), [], [], None, None
                part = b.slice(x, y - x)
                orders = int((part.column(2).to_numpy() >= 0).sum())  # orders come before features
                perms += part.column(2).slice(0, orders).to_pylist()
                place += [np.frombuffer(v.as_buffer(), np.int32) for v in part.column(3).slice(0, orders)]
                cells = part.column(4).slice(orders)
                if not len(cells):
                    continue
                if pan is None:
                    pan, core = (np.zeros((len(perms), total + 1), np.int32) for _ in "pc")
                size = cells.value_lengths().to_numpy()
                flat, start = cells.flatten().to_numpy(), np.cumsum(size) - size
                for p, own in enumerate(place):
                    held = own[flat]
                    first = np.minimum.reduceat(held, start)
                    np.add.at(pan[p], first, 1)
                    early = np.flatnonzero(first == 1)
                    core[p, 0] += len(first) - len(early)
                    for k in early.tolist():
                        run_ = np.sort(held[start[k] : start[k] + size[k]])
                        core[p, int((run_ == np.arange(1, len(run_) + 1)).argmin()) if run_[-1] != len(run_) else len(run_)] += 1
        yield from counted()

    def added(key: tuple, group: pa.Table) -> pa.Table:
        p, c = (sum(np.frombuffer(zlib.decompress(v.as_buffer()), np.int32).astype(np.int64) for v in group.column(k)) for k in ("pan", "core"))
        up, down = np.cumsum(p)[1:], np.cumsum(c[::-1])[::-1][1:]
        return pa.table({"perm": pa.array(np.full(total, key[0].as_py(), np.int32)), "n": pa.array(np.arange(1, total + 1, dtype=np.int32)), "pan": pa.array(up), "core": pa.array(down)})

    packed = kept(pav.join(F.broadcast(numbered), genome).groupBy(feature).agg(F.collect_set("_i").alias("cells")), "features")
    held = packed.agg(F.sum(F.size("cells"))).first()[0] or 0
    chunks = max(1, min(-(-held // CELLS), packed.count()))
    orders = kept(spark.range(0, n_perm, 1, n_perm).select(F.col("id").cast("int").alias("perm")).mapInArrow(ordered, "perm int, place binary"), "orders")
    every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    left = orders.select(every.alias("chunk"), F.expr(f"cast(perm div {per} as int)").alias("block"), "perm", "place", F.lit(None).cast("array<int>").alias("cells"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(-(-n_perm // per) - 1)))
    right = packed.select(F.pmod(F.xxhash64(feature), F.lit(chunks)).cast("int").alias("chunk"), blocks.alias("block"), F.lit(-1).alias("perm"), F.lit(None).cast("binary").alias("place"), "cells")
    met = left.unionByName(right).repartition(chunks * -(-n_perm // per), "chunk", "block").sortWithinPartitions("chunk", "block", F.desc("perm"))
    counts = met.select("chunk", "block", "perm", "place", "cells").mapInArrow(run, "perm int, pan binary, core binary")
    return counts.groupBy("perm").applyInArrow(added, "perm int, n int, pan long, core long")


def rarefaction_bands(curves: DataFrame) -> DataFrame:
    """Mean and the middle 95 % of pan and core over the permutations."""
    aggs = [x for c in ("pan", "core") for x in (F.avg(c).alias(f"{c}_mean"), F.percentile(c, F.lit(0.025)).alias(f"{c}_low"), F.percentile(c, F.lit(0.975)).alias(f"{c}_high"))]
    return curves.groupBy("n").agg(*aggs)


def heaps(bands: DataFrame) -> DataFrame:
    """kappa, gamma and openness of the law pan = kappa * n^gamma, by least squares of logarithms."""
    x, y = F.log("n"), F.log("pan_mean")
    fit = bands.agg(F.regr_slope(y, x).alias("gamma"), F.exp(F.regr_intercept(y, x)).alias("kappa"))
    return fit.withColumn("status", openness(F.col("gamma")))


def openness(gamma: Column) -> Column:
    return F.when(gamma > 0.8, "OPEN").when(gamma > 0.6, "MODERATELY OPEN").otherwise("CLOSED")


def genus_classes(counts: DataFrame, totals: DataFrame, core_share: float = 0.95, rare_share: float = 0.05) -> DataFrame:
    """Class of each feature in each species (Absent, Rare, Accessory, Core) from (og, species, n_genomes) and (species, total)."""
    # One row a feature, then one a species: the counts are read once and stay where they are dealt.
    own = counts.groupBy("og").agg(F.map_from_entries(F.collect_list(F.struct("species", "n_genomes"))).alias("_n"))
    grid = own.join(F.broadcast(totals)).withColumn("n_genomes", F.try_element_at("_n", F.col("species")))
    n = F.coalesce("n_genomes", F.lit(0))
    kind = F.when(n == 0, "Absent").when(n >= F.col("total") * core_share, "Core").when(n <= F.col("total") * rare_share, "Rare").otherwise("Accessory")
    return grid.select("og", "species", n.alias("n_genomes"), kind.alias("class"))
