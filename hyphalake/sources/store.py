"""Sinks: partitioned tables, wide exports, caches by name and resumable appends."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyphalake.operators.relational import pending


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds a finished table; asked of the store that Spark writes to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """One folder for each value of by; rows of a folder are dealt together, so folders have few files."""
    df.repartition(*[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def export_text(df: DataFrame, path: str, sep: str = "\t", one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def fingerprint(spark: SparkSession, inputs: Sequence[str], parameters: dict | None = None) -> str:
    """Digest of the parameters and of the inputs' files: their paths, lengths and times of change, not their rows."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    files = []
    for path in inputs:
        here = jvm.org.apache.hadoop.fs.Path(path)
        fs = here.getFileSystem(conf)
        if not fs.exists(here):
            files.append((path, -1, -1))
            continue
        found = fs.listFiles(here, True)
        while found.hasNext():
            f = found.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    said = json.dumps([sorted(files), parameters or {}], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()


def _marked(spark: SparkSession, path: str) -> str | None:
    """The fingerprint that stands beside a table, in a file that readers of the table skip."""
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_FINGERPRINT")
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(here):
        return None
    stream = fs.open(here)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False, inputs: Sequence[str] = (), parameters: dict | None = None) -> DataFrame:
    """The table at path; built and written first if it is not finished, force asks for it, or what it was made from
    (files of inputs, or parameters) is no longer the same.

    The fingerprint is taken before building and written after the table, so inputs that change meanwhile, or a
    run that breaks off, have it built again.  Tables kept without inputs and parameters are trusted as they stand.
    """
    mark = fingerprint(spark, inputs, parameters) if inputs or parameters else None
    if force or not exists(spark, path) or mark is not None and _marked(spark, path) != mark:
        build().write.mode("overwrite").parquet(path)
        if mark is not None:
            here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_FINGERPRINT")
            stream = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(here, True)
            try:
                stream.write(mark.encode())
            finally:
                stream.close()
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def append_missing(todo: DataFrame, path: str, keys: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> int:
    """Works on the rows of todo that the table at path lacks and appends the results; returns how many were open."""
    spark = todo.sparkSession
    left = pending(todo, spark.read.parquet(path), keys) if exists(spark, path) else todo
    n = left.count()
    if n:
        work(left).write.mode("append").parquet(path)
    return n


def preflight(spark: SparkSession, expected: dict[str, str]) -> DataFrame:
    """(name, path, present) of expected tables."""
    return spark.createDataFrame([(k, v, exists(spark, v)) for k, v in expected.items()], "name string, path string, present boolean")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The first of the tables that is there, or None."""
    return next((spark.read.parquet(p) for p in paths if exists(spark, p)), None)


def save_classified(rows: DataFrame, root: str, label: str = "Phenotype", unknown: Sequence[str] = ("Unknown", "Lab", "")) -> dict[str, str]:
    """All rows, those of a known class, and the columns that association needs, as three tables."""
    known = rows.where(F.col(label).isNotNull() & ~F.col(label).isin(*unknown))
    parts = {"all": rows, "known": known, "association": known.select(rows.columns[0], label)}
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in parts}
