"""Shared-folder scratch tables, prefix sums and connected components for the operators here.

Executors and the driver share only the folder named by ``spark.checkpoint.dir``; every table that
cuts lineage is written there through Spark's committer, so a lost executor never loses it.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.session import ship

#: Code points that count as white space in every contract here: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: Folders made for applications that name none, as tests do; by application.
_own: dict[str, str] = {}
#: Lists that runs which this thread begins now are noted in, the innermost last.
_noted = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a local one is made only where none is configured and all run on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        named = _own.setdefault(app, "") or f"file://{tempfile.mkdtemp(prefix='hyphalake-')}"
        _own[app] = named
    return named.rstrip("/")


def release() -> None:
    """Gives memory that a worker no longer needs back, as idle workers keep theirs between tasks."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Scratch:
    """Parquet tables of one operator run in the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables: list[str] = []
        for made in getattr(_noted, "lists", [])[-1:]:
            made.append(self)

    def keep(self, df: DataFrame, tag: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Writes df and returns a DataFrame that reads it back: its lineage ends here."""
        path = f"{self.root}/{tag}"
        schema = df.schema
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, tag: str, n: int, key: str, dealt: bool = False) -> DataFrame:
        """Like keep, in n buckets of key: what groups or joins by key later reads it without a shuffle.

        dealt: df has been repartitioned by key already.
        """
        name = f"scratch_{uuid.uuid4().hex}"
        (df if dealt else df.repartition(n, key)).write.format("parquet").option("compression", "zstd").bucketBy(n, key).option("path", f"{self.root}/{tag}").saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def drop(self, tag: str = "") -> None:
        """Deletes one table, or all of this run."""
        if not tag:
            for name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.tables.clear()
        _, files, path = _at(self.spark, f"{self.root}/{tag}".rstrip("/"))
        files.delete(path, True)


def _at(spark: SparkSession, where: str) -> tuple:
    """(the JVM, the file system of a path, the path)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return jvm, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def listed(spark: SparkSession, where: str) -> list[str]:
    """The paths of what a folder holds, asked of its own store."""
    _, files, path = _at(spark, where)
    return [x.getPath().toString() for x in files.listStatus(path)]


def there(spark: SparkSession, where: str) -> bool:
    """Whether a path exists, asked of its own store."""
    _, files, path = _at(spark, where)
    return files.exists(path)


@contextlib.contextmanager
def noted() -> Iterator[list[Scratch]]:
    """The runs that operators begin inside, and no others, so that sweep() can delete their tables once results are written."""
    made: list[Scratch] = []
    before = getattr(_noted, "lists", [])
    _noted.lists = [*before, made]
    try:
        yield made
    finally:
        _noted.lists = before


def sweep(made: list[Scratch]) -> None:
    """Deletes all tables of the given runs."""
    for scratch in made:
        scratch.drop()
    made.clear()


def in_fixed_order(df: DataFrame) -> bool:
    """Whether every scan of df gives the same rows in the same order and partitions, as files do and shuffles do not."""
    return df._jdf.queryExecution().toRdd().outputDeterministicLevel().toString() == "DETERMINATE"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60, tag: str = "cc") -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that can be reached.

    Alternates large-star and small-star rounds.  Minima are taken by a grouped aggregation with
    map-side partials and joined back, so that a node with very many neighbours is never gathered in
    one task.  Rounds end when the edges are stars, which a count compares.  Empty edges give an
    empty table; null ends are ignored.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        linked = both.join(low, both.u == low.w)
        if large:
            out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        return out.where("a <> b").distinct()

    now = scratch.keep(edges.select("a", "b").where("a <> b").distinct(), f"{tag}-0")
    before = None
    for k in range(1, max_rounds + 1):
        now = scratch.keep(star(star(now, True), False), f"{tag}-{k}")
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(f"{tag}-{k - 1}")
        if before is not None and (seen.n, seen.h) == before:
            break
        before = (seen.n, seen.h)
        if not seen.n:
            break
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
