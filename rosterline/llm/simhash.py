"""SimHash fingerprints joined through a Gray-order hierarchical index.

Fingerprints that differ in at most T bits agree on some n - T of n bit segments. A row per choice of
segments brings such fingerprints together; in each group they are sorted by Gray rank and a
hierarchy is laid over them whose nodes hold the bits all fingerprints below share. Two nodes are
compared on the bits both share; the differences add up from the top down, and a pair of groups is
dropped as a whole once they exceed T.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import components, local_roots, runs, split_hot, starts_of, table, text_pieces, unused, written

SHINGLE_WORDS = 4
MAX_DIFFERENT_BITS = 4
SEED = 42
#: Fingerprints of one group of segments that a task holds; larger groups are dealt into pairs of blocks.
GROUP_CAP = 20_000
#: Mean fingerprints per group up to which fewer segments are used.
MEAN_GROUP = 64
FANOUT = 8
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_UPPER = bytes(range(65, 91)), bytes(range(97, 123))
_LOWER = bytes.maketrans(*_UPPER)
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: a bit is set where over half of the shingles' XXH64 values have it."""
    tokens = _WORDS.findall(text.translate(_LOWER))
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    begins = np.concatenate(([0], ends[: -words] + 1)).tolist()
    hashes = [digest(joined[a:b], SEED) for a, b in zip(begins, ends[words - 1 :].tolist(), strict=True)]
    parts = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    value = 0
    for k in range(8):
        ones = np.bincount(parts[:, k], minlength=256) @ _BITS
        value |= sum(1 << (8 * k + i) for i in np.flatnonzero(2 * ones > len(hashes)).tolist())
    return value


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; the unsigned fingerprint is held in a signed long. Null texts count as empty."""
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            texts = piece.column(1).cast(pa.binary())
            got = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(got)], names=["doc_id", "fp"])

    ids = F.col(id_column).cast("long").alias("doc_id")
    return docs.select(ids, text).mapInArrow(run, "doc_id long, fp long")


def segments_for(n: int, max_bits: int = MAX_DIFFERENT_BITS) -> int:
    """Number of segments: the fewest that make groups of about MEAN_GROUP; every choice finds every pair."""
    for s in range(max_bits + 1, 2 * max_bits + 5):
        if n / 2.0 ** (64 * (s - max_bits) / s) <= MEAN_GROUP:
            return s
    return 2 * max_bits + 4


def segment_masks(segments: int, max_bits: int) -> list[int]:
    """Bit masks of all choices of segments - max_bits segments."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, segments - max_bits)]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order: neighbours in this order differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over codes sorted by (group, Gray rank); no node spans two groups.

    Level 0 holds the codes. A node above holds ``shared``, a mask of the bits equal in all codes below,
    and ``pattern``, those bits. ``own`` is the part of the mask that its parent lacks.
    """

    def __init__(self, codes: np.ndarray, groups: np.ndarray, fanout: int = FANOUT):
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.pattern, self.shared, self.first = [codes], [np.full(len(codes), full)], []
        low, high, group = codes, codes, groups
        while True:
            start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            if len(start) == len(group):
                break
            inside = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
            begin = np.flatnonzero(inside % fanout == 0)
            low, high = np.bitwise_and.reduceat(low, begin), np.bitwise_or.reduceat(high, begin)
            mask = ~(low ^ high)
            self.pattern.append(low & mask)
            self.shared.append(mask)
            self.first.append(np.append(begin, len(group)))
            group = group[begin]

    def pairs(self, limit: int, accept=None, chunk: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (i, j), i < j, of codes in one group that differ in at most ``limit`` bits.

        Depth first over pairs of nodes; what is held at once is bounded by ``chunk`` times the depth.
        """
        top = len(self.pattern) - 1
        roots = np.arange(len(self.pattern[top]))
        stack = [(top, roots, roots, np.zeros(len(roots), np.uint8), np.zeros(len(roots), np.uint64))]
        while stack:
            level, a, b, acc, seen = stack.pop()
            if len(a) > chunk:
                for k in range(0, len(a), chunk):
                    stack.append((level, *(x[k : k + chunk] for x in (a, b, acc, seen))))
                continue
            common = self.shared[level][a] & self.shared[level][b]
            fresh = common & ~seen
            acc = acc + np.bitwise_count((self.pattern[level][a] ^ self.pattern[level][b]) & fresh)
            near = acc <= limit
            a, b, acc, common = a[near], b[near], acc[near], common[near]
            if not len(a):
                continue
            if level == 0:
                apart = a < b
                yield a[apart], b[apart]
                continue
            first = self.first[level - 1]
            na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
            count = na * nb
            if count.sum() > 4 * chunk and len(a) > 1:
                half = len(a) // 2
                zero = np.zeros(len(a), np.uint64)
                for part in (slice(0, half), slice(half, None)):
                    stack.append((level, a[part], b[part], acc[part] * 0, zero[part]))
                continue
            owner = np.repeat(np.arange(len(a)), count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            ca, cb = first[a][owner] + inner // nb[owner], first[b][owner] + inner % nb[owner]
            keep = ca <= cb
            stack.append((level - 1, ca[keep], cb[keep], acc[owner][keep], common[owner][keep]))


def near_links(codes: DataFrame, n: int, max_bits: int = MAX_DIFFERENT_BITS, cap: int = GROUP_CAP) -> DataFrame:
    """Links (src, dst) over distinct ``fp`` that join exactly those reachable by differences of at most max_bits.

    Inside a group every near pair is found, but only a spanning set of links leaves the task, so a large
    group of near copies gives as many links as it has members.
    """
    masks = segment_masks(segments_for(n, max_bits), max_bits)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("seg")) for t, m in enumerate(masks)])
    rows = codes.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.seg")
    dealt = split_hot(rows, ["t", "seg"], F.col("fp"), cap)
    order = ["t", "seg", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, order, 200_000):
            fp = part.column("fp").to_numpy().view(np.uint64)
            sides = part.column("blk").to_numpy() == part.column("bi").to_numpy()
            cross = part.column("bi").to_numpy() != part.column("bj").to_numpy()
            begins = starts_of(part, order)
            group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(fp))))
            at = np.lexsort((gray_rank(fp), group))
            fp, group, side, cross = fp[at], group[at], sides[at], cross[at]
            index = GrayIndex(fp, group)
            root = np.arange(len(fp))
            held, m = [], 0

            def fold() -> None:
                nonlocal root, held, m
                a, b = (np.concatenate(x) for x in zip(*held, strict=True))
                root = local_roots(np.concatenate((a, np.arange(len(root)))), np.concatenate((b, root)), len(root))
                held, m = [], 0

            for a, b in index.pairs(max_bits):
                use = ~cross[a] | (side[a] != side[b])
                held.append((a[use], b[use]))
                m += int(use.sum())
                if m > 1_000_000:
                    fold()
            if held:
                fold()
            linked = np.flatnonzero(root != np.arange(len(root)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))], names=["src", "dst"]
                )

    sorted_rows = dealt.select("fp", *order, "blk").repartition(*order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(run, "src long, dst long").distinct()


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_DIFFERENT_BITS, cap: int = GROUP_CAP) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    Documents with equal fingerprints are one class and are compared once. Texts without words have
    fingerprint zero and are linked like any other. component_id is the smallest doc_id reachable; a
    row without doc_id takes part but never names a component that has another id. Repeated rows
    stay. No documents give no rows.
    """
    fps = written(fingerprints(docs, id_column, text_column, words))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = written(classes)
    star = components(near_links(classes.select("fp"), classes.count(), max_bits, cap))
    joined = classes.join(star.withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.withColumn("component", F.coalesce("component", "fp"))
    least = written(joined.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = joined.join(least, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_DIFFERENT_BITS) -> DataFrame:
    """``docs`` with one row of every group of near copies: the one of the smallest id, null ids last.

    Rows get a number of their own first, so repeated and missing ids are told apart.
    """
    row, group = unused(docs.columns, "row", "group")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = near_groups(rows, row, text_column, words, max_bits).select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
    return first_of_groups(rows, groups, row, group, id_column).select(*docs.columns)


def first_of_groups(rows: DataFrame, groups: DataFrame, row: str, group: str, id_column: str) -> DataFrame:
    """The rows of ``rows`` that come first in their group, by ``id_column`` (nulls last), then by ``row``."""
    order = F.struct(F.col(id_column).isNull().alias("missing"), F.col(id_column).alias("id"), F.col(row).alias("row"))
    named = rows.select(row, id_column).join(groups, row)
    first = named.groupBy(group).agg(F.min(order).alias("first")).select(F.col("first.row").alias(row))
    return rows.join(first, row, "left_semi")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
