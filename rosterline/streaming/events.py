"""Streams: new files as they arrive, windowed counts with late data, copies dropped within a time limit.

The same functions run over batches, which is what tests hold the streams against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.plans.fixtures import load


def new_files(spark: SparkSession, path: str, pattern: str = "*", per_trigger: int = 1000) -> DataFrame:
    """Files as they appear under a folder, with content and fingerprint."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern)
    stream = stream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(path)
    return stream.withColumn("sha256", F.sha2("content", 256))


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", time: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    """Count and sum per key and tumbling window; on a stream, windows close once ``late`` has passed."""
    rows = events
    if events.isStreaming:  # a watermark needs a time zone, which the files' times may lack
        rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    got = rows.groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return got.select(F.col("window.start").alias("window_start"), key, "n", "total")


def first_within(rows: DataFrame, key: str, time: str = "ts", limit: str = "1 hour") -> DataFrame:
    """On a stream, the first row of each key; the state of a key is dropped after ``limit``."""
    return rows.withWatermark(time, limit).dropDuplicatesWithinWatermark([key])


def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(load(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


STREAM_QUERIES = {"stream_hourly_counts": stream_hourly_counts}
STREAM_ORACLES = {
    "stream_hourly_counts": """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"""
}
