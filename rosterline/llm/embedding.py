"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample so that the signs of the rotated vector make balanced binary
codes. Parts of the codes are keys of hash tables, and only codes travel to the tables: of the vectors that
share a key, those that are near by Hamming distance, in the first table where they meet, are looked up in
full and compared by cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import components, local_roots, runs, split_hot, starts_of, table, written

COSINE = 0.95
#: Vectors the rotation is fitted on.
SAMPLE_ROWS = 4096
#: Mean vectors per bucket for which the key length is chosen, and the largest bucket held at once.
MEAN_BUCKET, BUCKET_CAP = 64, 4096
#: Chance that a pair just at the cosine limit meets in some table, for which the number of tables is chosen.
RECALL = 0.995
SEED = 11
BLOCK = 512
#: Codes of 64 bits that the Hamming distance is taken over at most, and how far over the mean its limit lies.
FILTER_CODES, SPREAD = 4, 6.0


def fit_rotations(sample: np.ndarray, count: int, rounds: int = 20, seed: int = SEED) -> list[np.ndarray]:
    """``count`` projections to binary codes, each d x bits, by iterative quantisation from a random start.

    Rounds alternate between the signs of the rotated sample and the orthogonal matrix that brings the
    sample closest to them. With fewer rows than dimensions the random rotation is kept.
    """
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    bits = min(64, d)
    scale = np.eye(d)[:, :bits]
    if len(sample) >= 2 * d:
        centred = sample - sample.mean(axis=0)
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        scale = axes[:bits].T
    found = []
    for _ in range(count):
        turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        if len(sample) >= 2 * d:
            v = sample @ scale
            for _ in range(rounds):
                u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
                turn = (u @ w).T
        found.append(scale @ turn)
    return found


def plan_tables(n: int, dims: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits per key and number of tables for ``n`` vectors; every size gets the same chance of meeting."""
    bits = max(6, min(30, round(math.log2(max(n, 1) / MEAN_BUCKET)) if n > MEAN_BUCKET else 6))
    bits = min(bits, dims)
    same = (1 - math.acos(min(cosine, 1.0)) / math.pi) ** bits
    return bits, max(4, math.ceil(math.log(1 - recall) / math.log(1 - same)))


class Codes:
    """Binary codes of vectors and their keys in all tables. Vectors of other lengths than the fitted ones get seeded rotations."""

    def __init__(self, rotations: dict[int, list[np.ndarray]], bits: int, tables: int, cosine: float):
        self.rotations, self.bits, self.tables, self.cosine = rotations, bits, tables, cosine

    def rotations_of(self, d: int) -> list[np.ndarray]:
        if d not in self.rotations:
            need = math.ceil(self.tables / max(1, min(64, d) // min(self.bits, d)))
            self.rotations[d] = fit_rotations(np.zeros((0, d)), need)
        return self.rotations[d]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, rotations) codes, one unsigned number per rotation."""
        place = np.uint64(1) << np.arange(min(64, x.shape[1]), dtype=np.uint64)
        return np.stack([(x @ r >= 0) @ place for r in self.rotations_of(x.shape[1])], axis=1)

    def keys(self, codes: np.ndarray, d: int) -> np.ndarray:
        """(rows, tables) keys; the length of the vectors is mixed in, so other lengths never meet."""
        bits = min(self.bits, d)
        parts = [(codes[:, [r]] >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1) for r in range(codes.shape[1]) for k in range(min(64, d) // bits)]
        return np.concatenate(parts[: self.tables], axis=1).astype(np.int64) + (np.int64(d) << 32)

    def near(self, codes: np.ndarray, d: int) -> tuple[np.ndarray, int]:
        """The codes by which vectors are told near, and at how many differing bits.

        At the cosine limit a bit differs with a chance of angle / pi; the limit lies SPREAD standard deviations above.
        """
        used = codes[:, :FILTER_CODES]
        n, p = used.shape[1] * min(64, d), math.acos(min(self.cosine, 1.0)) / math.pi
        return used, math.ceil(n * p + SPREAD * math.sqrt(n * p * (1 - p)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one batch as a matrix; all rows have the same length."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1)


def usable(embedding: str) -> F.Column:
    """Neither null nor empty nor zero, and all components finite numbers."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(sound & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS, cap: int = BUCKET_CAP) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Equal vectors are one class, compared once; their rows are linked with each other. Vectors that are
    null, empty, zero or hold null or non-finite components, and rows without an id, link with nothing.
    Vectors of different lengths never link. Rows that repeat an id count as rows of their own. Equal vectors are told
    by a 128-bit hash. Only id and vector are read, so further columns do not matter; no rows give none.
    """
    kind = vectors.schema[vector_column].dataType
    vector = F.col(vector_column) if kind.simpleString() == "array<float>" else F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("embedding"))
    sound = rows.where(usable("embedding") & F.col("vec_id").isNotNull())
    equal = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    classes = sound.groupBy("embedding").agg(F.min("vec_id").alias("cid"), F.count("*").alias("mult"))
    classes = written(classes.select("embedding", "cid", "mult", *equal, F.monotonically_increasing_id().alias("uid")))
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("embedding", F.lit(SEED)), "cid").limit(sample_rows).select("embedding").toPandas()["embedding"]
    by_length: dict[int, list] = {}
    for v in sample:
        by_length.setdefault(len(v), []).append(v)
    dims = max((len(v), d) for d, v in by_length.items())[1] if by_length else 1
    bits, tables = plan_tables(n, dims, cosine, recall)
    rotations = {}
    for d, v in by_length.items():
        x = np.array(v, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rotations[d] = fit_rotations(x, math.ceil(tables / max(1, min(64, d) // min(bits, d))))
    codes = Codes(rotations, bits, tables, cosine)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().to_numpy() if batch.num_rows else np.zeros(0, int)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = _unit(_matrix(column.take(pa.array(at))))
                code = codes.codes(x)
                keys = codes.keys(code, int(d))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), d, np.int32)), pa.array(list(code.view(np.int64)), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["uid", "d", "code", "keys"],
                )

    keyed = written(classes.select("uid", "embedding").mapInArrow(encode, "uid long, d int, code array<long>, keys array<long>"))
    slim = keyed.select("uid", "d", "code", F.posexplode("keys").alias("t", "k"))
    order = ["t", "k", "bi", "bj"]
    dealt = split_hot(slim, ["t", "k"], F.col("uid"), cap).repartition(*order).sortWithinPartitions(*order, "uid")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, order, 20_000):
            begins = starts_of(part, order)
            ends = np.append(begins[1:], part.num_rows)
            t, blk, size = part.column("t").to_numpy(), part.column("blk").to_numpy(), part.column("d").to_numpy()
            cross = part.column("bi").to_numpy() != part.column("bj").to_numpy()
            column = part.column("code").combine_chunks()
            met = np.zeros(part.num_rows, bool)
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                if b - a > 1:
                    own = column.slice(a, b - a).flatten().to_numpy().view(np.uint64).reshape(b - a, -1)
                    met[a:b] = _meets(codes, own, int(size[a]), int(t[a]), blk[a:b] if cross[a] else None)
            if met.any():
                yield part.select(["uid", "code", *order, "blk"]).filter(pa.array(met)).combine_chunks().to_batches()[0]

    near = dealt.select("uid", "d", "code", *order, "blk").mapInArrow(probe, "uid long, code array<long>, t int, k long, bi int, bj int, blk int")
    full = near.join(classes.select("uid", "embedding", "mult"), "uid")
    placed = full.repartition(*order).sortWithinPartitions(*order, "uid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, order, 20_000):
            begins = starts_of(part, order)
            ends = np.append(begins[1:], part.num_rows)
            uid, mult = part.column("uid").to_numpy(), part.column("mult").to_numpy()
            t, blk = part.column("t").to_numpy(), part.column("blk").to_numpy()
            cross = part.column("bi").to_numpy() != part.column("bj").to_numpy()
            column, code = part.column("embedding").combine_chunks(), part.column("code").combine_chunks()
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                if b - a > 1:
                    x = _unit(_matrix(column.slice(a, b - a)))
                    own = code.slice(a, b - a).flatten().to_numpy().view(np.uint64).reshape(b - a, -1)
                    links, root = _bucket(x, codes.keys(own, x.shape[1]), int(t[a]), mult[a:b], blk[a:b] if cross[a] else None, cosine)
                    hit = np.flatnonzero(links)
                    for held, value in zip(out, (uid[a:b][hit], links[hit], uid[a:b][root[hit]]), strict=True):
                        held.append(value)
            if out[0]:
                got = [pa.array(np.concatenate(x)) for x in out]
                yield pa.RecordBatch.from_arrays(got, names=["uid", "links", "root"])

    found = written(placed.select("uid", "embedding", "code", "mult", *order, "blk").mapInArrow(compare, "uid long, links long, root long"))
    star = components(found.select(F.col("uid").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    named = classes.select("uid", "cid", "mult", "k1", "k2").join(links, "uid", "left")
    named = named.join(star.withColumnRenamed("node", "uid"), "uid", "left")
    named = named.withColumn("component", F.coalesce("component", "uid"))
    least = written(named.groupBy("component").agg(F.min("cid").alias("component_id")))
    named = named.join(least, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id"
    )
    linked = sound.select("vec_id", *equal).join(named, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(usable("embedding") & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _meets(codes: Codes, code: np.ndarray, d: int, t: int, blk: np.ndarray | None) -> np.ndarray:
    """Which vectors of a bucket have a Hamming neighbour in it that no earlier table brought them together with."""
    used, limit = codes.near(code, d)
    keys = codes.keys(code, d)[:, :t]
    met = np.zeros(len(code), bool)
    for i in range(0, len(code), BLOCK):
        for j in range(i, len(code), BLOCK):
            apart = np.zeros((len(used[i : i + BLOCK]), len(used[j : j + BLOCK])), np.uint16)
            for word in used.T:
                apart += np.bitwise_count(word[i : i + BLOCK, None] ^ word[None, j : j + BLOCK])
            a, b = np.nonzero(apart <= limit)
            a, b = a + i, b + j
            use = (a < b) & ~(met[a] & met[b])
            if blk is not None:
                use &= blk[a] != blk[b]
            a, b = a[use], b[use]
            if t and len(a):
                new = ~(keys[a] == keys[b]).any(axis=1)
                a, b = a[new], b[new]
            met[a] = met[b] = True
    return met


def _bucket(x: np.ndarray, keys: np.ndarray, t: int, mult: np.ndarray, blk: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector of a bucket that meet here first, and the first member of its local component."""
    n = len(x)
    links, root = np.zeros(n, np.int64), np.arange(n)
    for i in range(0, n, BLOCK):
        for j in range(i, n, BLOCK):
            hit = x[i : i + BLOCK] @ x[j : j + BLOCK].T >= cosine
            a, b = np.nonzero(hit)
            a, b = a + i, b + j
            use = a < b
            if blk is not None:
                use &= blk[a] != blk[b]
            a, b = a[use], b[use]
            if t and len(a):
                new = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
                a, b = a[new], b[new]
            if len(a):
                np.add.at(links, a, mult[b])
                np.add.at(links, b, mult[a])
                root = local_roots(np.concatenate((a, np.arange(n))), np.concatenate((b, root)), n)
    return links, root


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v
  WHERE vec_id IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a AS s, b AS d FROM links
  UNION
  SELECT r.s, l.b FROM reach r JOIN links l ON l.a = r.d
), least AS (SELECT s, min(d) AS m FROM reach GROUP BY s),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(deg.n, 0) AS n_links,
       least(v.vec_id, coalesce(least.m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(least.m, v.vec_id)) AS kept
FROM v LEFT JOIN deg ON deg.a = v.vec_id LEFT JOIN least ON least.s = v.vec_id
"""
