"""The folder that driver and executors share, and tables kept in it for the time of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is named and all run on one machine, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _own.get(app) or _own.setdefault(app, f"file://{tempfile.mkdtemp(prefix='hyphalake-')}")
    return root.rstrip("/")


#: Tables kept so far, by application.
_tables: dict[str, list[str]] = {}


def kept(df: DataFrame, tag: str) -> DataFrame:
    """df, written to the shared folder and read back, so that what follows neither repeats nor depends on its lineage."""
    path = f"{shared_folder(df.sparkSession)}/kept-{tag}-{uuid.uuid4().hex}"
    _tables.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def forget(spark: SparkSession) -> int:
    """Deletes all tables this application has kept, once the results that read them are written; returns how many."""
    paths = _tables.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(here, True)
    return len(paths)
