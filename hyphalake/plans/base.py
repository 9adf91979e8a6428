"""Registration of queries with their SQL twins, and the tables they stand on.

The driver's tables stand in for the genomics schema: a part is a feature (orthogroup), a supplier a
genome, an order line a protein, and a supplier's region its species.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        ship(spark)
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def genomes(self) -> DataFrame:
        """(genome, nation, species): bounded by the number of suppliers."""
        return self.supplier.join(F.broadcast(self.nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(self.region), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("genome"), F.col("n_name").alias("nation"), F.col("r_name").alias("species"))

    def members(self) -> DataFrame:
        """(og, genome, species, protein)."""
        lines = self.lineitem.select(F.col("l_partkey").alias("og"), F.col("l_suppkey").alias("genome"), F.concat_ws("|", "l_orderkey", "l_linenumber").alias("protein"))
        return lines.join(self.genomes().select("genome", "species"), "genome")

    def pav(self) -> DataFrame:
        return self.lineitem.select(F.col("l_partkey").alias("og"), F.col("l_suppkey").alias("genome")).distinct()


MEMBERS = """genomes AS (SELECT s_suppkey AS genome, n_name AS nation, r_name AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
members AS (SELECT l_partkey AS og, l_suppkey AS genome, species, l_orderkey || '|' || l_linenumber AS protein FROM lineitem JOIN genomes ON l_suppkey = genome),
pav AS (SELECT DISTINCT og, genome, species FROM members),
freq AS (SELECT og, count(*) AS n_genomes FROM pav GROUP BY og),
classes AS (SELECT og, n_genomes, CASE WHEN n_genomes >= least(30, total) THEN 'Core' WHEN n_genomes <= least(20, total * 4 // 5) THEN 'Rare' ELSE 'Accessory' END AS pangenome_class FROM freq, (SELECT count(*) AS total FROM supplier))"""

#: Thresholds of the surrogate classes, which have no U-shaped histogram; with fewer genomes, all of them and four in five.
CORE_N, RARE_N = 30, 20


def query(name: str, sql: str | None = None) -> Callable:
    """Registers f(tables) -> DataFrame under a name; sql is its twin."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[name] = sql.replace("{members}", MEMBERS)
        return f

    return add


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})
