"""Session factory, and the package's way to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "hyphalake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that tasks can import it wherever it lies here."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="hyphalake-")) / "hyphalake.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
