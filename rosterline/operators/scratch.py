"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where that is unset (one machine) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="rosterline-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session is gone; the shared folder is the cluster's to clear
        return


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder, emptied when the session's program ends."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: lost executors cost no recomputation, lineage ends here."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    got = df.sparkSession.read.schema(df.schema).parquet(path)
    got.written_at = path
    return got


def drop_written(df: DataFrame) -> None:
    """Removes a table that came from ``written`` and that no later step reads; anything else stays as it is."""
    path = df.__dict__.get("written_at")
    if path:
        _remove(df.sparkSession, path)
