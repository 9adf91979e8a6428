"""Structured Streaming over an event table: windows with late data, sessions and deduplication.

The analyses have no stream; these operators are an extension for the same tables arriving as files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _timed(events: DataFrame, ts: str) -> DataFrame:
    """Event times without zone are UTC."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by tumbling window and kind; state is dropped once the watermark has passed a window."""
    return _timed(events, ts).withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return _timed(events, ts).withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("s"), user).agg(F.count(F.lit(1)).alias("n")).select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), user, "n")


def first_seen(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    return _timed(events, ts).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
