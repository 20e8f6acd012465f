"""Shared pieces: written tables that cut lineage, links to components, splitting of hot groups."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.operators.scratch import drop_written, scratch_path, shared_folder, written  # noqa: F401

#: Bytes of text that a Python worker works on at once; one longer text is a piece of its own.
PIECE_BYTES = 8 << 20
#: Arrow batches of a session that runs all stages in one set of executors.
BATCH_BYTES = 4 << 20
_KEPT: dict[Any, Any] = {}


def kept(name: Any, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps from task to task under ``name``; what it kept for another operator goes first."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Hands memory that Arrow and the C library hold but do not use back to the system; workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], name: Any = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` in a worker that keeps nothing but what is under ``name`` and hands back the rest before and after."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [k for k in _KEPT if k != name]
        for k in others:
            del _KEPT[k]
        if others:
            give_back()
        yield from run(batches)
        give_back()

    return whole


def lean(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """From now on the session's Arrow batches have at most ``size`` bytes; a lower limit stays.

    A batch stands in the executor and in the worker at once, on its way in and out, for every task. The limit is the
    session's because what a stage returns is only worked out after it has returned.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= size:
        spark.conf.set(name, f"{size}b")


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """Arrow batches of at most ``size`` bytes, or fewer where the session has less, for the jobs inside, which hold several rows of long lists at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    lean(spark, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that, in any case of letters, none of ``taken`` has."""
    held = {c.lower() for c in taken}
    found = []
    for name in names:
        own = f"__{name}"
        while own.lower() in held:
            own += "_"
        held.add(own.lower())
        found.append(own)
    return found


def text_pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of ``column`` each, whole rows only."""
    for batch in batches:
        if not batch.num_rows:
            continue
        array = batch.column(batch.schema.get_field_index(column))
        width = np.int64 if pa.types.is_large_string(array.type) else np.int32
        ends = np.frombuffer(array.buffers()[1], dtype=width)[array.offset : array.offset + len(array) + 1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, int(ends[begin]) + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` over slices of bounded text size; it is called once per slice in the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            out = work(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable position for each of ``n`` positions under the links a-b."""
    root = np.arange(n)
    if not len(a):
        return root
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        if np.array_equal(root[a], root[b]):
            return root


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (src, dst): one row (node, component) per linked node.

    Alternates large-star and small-star steps. Each step only takes minima per node, which Spark
    sums up before the shuffle, and joins them back. The minima are a written table, so both sides of
    the join are plain shuffles and the adaptive skew join can split a hub with a third of all links.
    ``component`` is the smallest node reachable. Null ends and loops are
    ignored. Rounds are logarithmic in the longest chain; every round is a written table.
    """
    edges = written(
        links.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    before = _signature(edges)
    while before[0]:
        ends = edges.union(edges.select(F.col("v"), F.col("u")))
        least = written(ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = ends.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after_edges = written(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(after_edges)
        for done in (edges, least, low):
            drop_written(done)
        edges = after_edges
        if after == before:
            break
        before = after
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def split_hot(rows: DataFrame, keys: list[str], member: Column, cap: int) -> DataFrame:
    """Adds bi, bj, blk: the pair of blocks in which a row takes part, and the row's own block.

    A group of at most ``cap`` rows is one block. A larger one is dealt into B = ceil(rows / cap)
    blocks by a hash of ``member``, and each row goes to the B pairs of blocks that include its own,
    so every pair of rows still meets exactly once and no task holds over about two blocks.
    """
    hot = rows.groupBy(*keys).count().where(F.col("count") > cap)
    hot = hot.select(*keys, F.ceil(F.col("count") / F.lit(cap)).cast("int").alias("n_blk"))
    got = rows.join(hot, keys, "left").withColumn("n_blk", F.coalesce("n_blk", F.lit(1)))
    got = got.withColumn("blk", F.pmod(F.xxhash64(member, F.lit(7)), F.col("n_blk").cast("long")).cast("int"))
    got = got.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n_blk") - 1)))
    return got.withColumns({"bi": F.least("blk", "o"), "bj": F.greatest("blk", "o")}).drop("n_blk", "o")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows of sorted input, cut only where a key changes."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            cut = _last_start(table, keys)
            if cut:
                yield table.slice(0, cut)
                table = table.slice(cut)
            held, n = table.combine_chunks().to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _last_start(table: pa.Table, keys: list[str]) -> int:
    return int(starts_of(table, keys)[-1])


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a new key begins in a sorted table."""
    fresh = np.zeros(table.num_rows, bool)
    fresh[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        fresh[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
