"""Every query with SQL gives what DuckDB gives; every stream gives what its batch gives."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from rosterline.plans.registry import ORACLES, QUERIES
from rosterline.streaming import events

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        path = Path(f"{SF}/{t}.parquet")
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return connection


def canonical(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
            return None
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return bool(x)
        try:
            return round(float(x), 6) if not isinstance(x, (str, bytes, pd.Timestamp)) else x
        except TypeError:
            return x

    rows = [tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and {"classify_students", "pipeline"} <= set(entry.queries()) | {"pipeline"}


def test_stream_counts_equal_batch(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet")
    rows.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = events.windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), late="100 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    both = [df.select(F.col("window_start").cast("timestamp").alias("window_start"), "event_type", "n", F.round("total", 3).alias("total")) for df in (spark.table("counts"), events.windowed_counts(rows))]
    assert canonical(both[0].toPandas()) == canonical(both[1].toPandas())


def test_stream_drops_copies_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a.txt", "x"), ("b.txt", "x"), ("c.txt", "y")):
        (tmp_path / "in" / name).write_text(text)
    files = events.new_files(spark, str(tmp_path / "in"), "*.txt").withColumn("ts", F.current_timestamp())
    query = events.first_within(files, "sha256").select("sha256").writeStream.format("memory").queryName("files").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert spark.table("files").count() == 2
