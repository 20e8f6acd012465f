"""Shards by fixed virtual slots.

Records are hashed into thousands of slots, bytes are summed per slot, and a stored, versioned map sends
each slot to a shard. The map has as many rows as there are slots whatever the corpus holds, so
it is planned on the driver; the records are only ever joined with that small map, read back from its table.
Equal texts are not kept together: a group of copies can be larger than a shard, and then no law could hold.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.llm.common import scratch_path, table

SLOTS = 8192
SHARDS = 40
#: Bytes that a record takes in a shard besides its text.
RECORD_BYTES = 16

MAP_SCHEMA = "version int, virtual_slot int, shard int, slot_bytes long, slot_rows long"


def with_slots(records: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """id, size, text_crc32 and virtual_slot of every record.

    Null texts have no bytes and the crc of the empty text. The slot is a hash of id, crc and the number of the copy, so
    rows without an id and rows that repeat as a whole still spread over the slots. Equal rows are counted before the
    shuffle and dealt out again after it.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    crc = F.crc32(F.encode(text, "UTF-8"))
    size = (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long")
    got = records.select(F.col(id_column).alias("doc_id"), size.alias("size"), crc.alias("text_crc32"))
    got = got.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    got = got.select("doc_id", "size", "text_crc32", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    digits = F.substring(F.md5(F.concat_ws(":", "doc_id", "text_crc32", "copy").cast("binary")), 1, 8)
    slot = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")
    return got.withColumn("virtual_slot", slot)


def slot_loads(slotted: DataFrame) -> DataFrame:
    """Bytes and rows of each used slot; summed before the shuffle."""
    return slotted.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def plan_map(loads: list[tuple[int, int, int]], shards: int = SHARDS, slots: int = SLOTS) -> list[tuple]:
    """Version 1 of the map from (slot, bytes, rows): the heaviest slot goes to the lightest shard each time."""
    weight = {s: (b, r) for s, b, r in loads}
    heap = [(0, 0, k) for k in range(shards)]
    plan = []
    for s in sorted(range(slots), key=lambda s: (-weight.get(s, (0, 0))[0], s)):
        b, r = weight.get(s, (0, 0))
        held, n, k = heapq.heappop(heap)
        plan.append((1, s, k, b, r))
        heapq.heappush(heap, (held + b, n + 1, k))
    return sorted(plan, key=lambda row: row[1])


def rebalance(plan: list[tuple], loads: list[tuple[int, int, int]], shards: int, tolerance: float = 0.02) -> list[tuple]:
    """The next version of a map for new loads or another shard count, edited in as few slots as it takes.

    Slots of shards that no longer exist move first; then the heaviest shard gives its largest fitting
    slot to the lightest one until all are within ``tolerance`` of the mean or no move helps.
    """
    version = max((row[0] for row in plan), default=0) + 1
    weight = {s: (b, r) for s, b, r in loads}
    of = {s: k for _, s, k, _, _ in plan}
    total = [0] * shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    loose = []
    for s, k in of.items():
        b = weight.get(s, (0, 0))[0]
        if k < shards:
            total[k] += b
            held[k][s] = b
        else:
            loose.append((b, s))
    for b, s in sorted(loose, key=lambda x: (-x[0], x[1])):
        k = min(range(shards), key=lambda k: (total[k], k))
        of[s], held[k][s] = k, b
        total[k] += b
    mean = sum(total) / shards
    for _ in range(len(of)):
        high = max(range(shards), key=lambda k: (total[k], -k))
        low = min(range(shards), key=lambda k: (total[k], k))
        gap = total[high] - total[low]
        if total[high] <= mean * (1 + tolerance) and total[low] >= mean * (1 - tolerance):
            break
        fits = [(b, -s) for s, b in held[high].items() if 0 < b < gap]
        if not fits:
            break
        b, s = min(fits, key=lambda x: (abs(2 * x[0] - gap), x))
        s = -s
        del held[high][s]
        held[low][s] = b
        of[s] = low
        total[high] -= b
        total[low] += b
    return [(version, s, k, *weight.get(s, (0, 0))) for s, k in sorted(of.items())]


def _stored(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def store_map(spark: SparkSession, plan: list[tuple], path: str) -> None:
    """Adds a version to the map table; earlier versions stay, so records placed by them can still be found."""
    spark.createDataFrame(plan, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest where none is named."""
    versions = spark.read.schema(MAP_SCHEMA).parquet(path)
    latest = versions.agg(F.max("version")).first()[0] if version is None else version
    return versions.where(F.col("version") == F.lit(latest))


def assign(slotted: DataFrame, placed: DataFrame) -> DataFrame:
    """shard and slot (place in the shard, gapless from 0) of every record, by one version of the map.

    Places are numbered inside each virtual slot and offset by the rows of the shard's earlier slots,
    so no task ever sorts a whole shard. The map has one row per virtual slot and is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    small = placed.select("virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("slot_offset"), F.col("version").alias("map_version"))
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")
    numbered = slotted.withColumn("place", F.row_number().over(order).cast("long") - 1)
    return numbered.join(F.broadcast(small), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot_offset") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def shard_documents(records: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_column: str = "doc_id", text_column: str = "text", maps: str | None = None) -> DataFrame:
    """Every record with its shard under the law that shard bytes are nearly equal.

    ``maps`` is the folder of the map table: the first run stores version 1 there, each later run edits the latest
    version for the new loads or shard count and stores the next. Without it a new table is kept in the shared folder.
    Empty input gives an empty result. Extra columns are left out, so clashing names do not matter.
    """
    spark = records.sparkSession
    maps = maps or scratch_path(spark)
    slotted = with_slots(records, id_column, text_column, slots)
    loads = [tuple(row) for row in slot_loads(slotted).collect()]  # at most ``slots`` rows
    if _stored(spark, maps):
        plan = rebalance([tuple(row) for row in stored_map(spark, maps).collect()], loads, shards)
    else:
        plan = plan_map(loads, shards, slots)
    store_map(spark, plan, maps)
    return assign(slotted, stored_map(spark, maps, plan[0][0]))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
