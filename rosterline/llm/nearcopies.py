"""Near copies by the Jaccard similarity of word shingles: the Gray index over SimHash fingerprints first, then the rest.

Fingerprints of five-word shingles that differ in few bits are found by the hierarchical index of ``simhash``
and linked once all their shingles are compared, by 64-bit hashes. At a similarity of 0.8 fingerprints of 64 bits differ in
about ten bits and often in more, while those of unrelated texts come that near too, so no bit limit reaches
all such copies; the exact way for the rest is that texts which share a band of minima meet in a bucket, and
those not linked yet are compared there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import components, drop_written, runs, small_batches, split_hot, starts_of, text_pieces, tidy, unused, written
from rosterline.llm.simhash import _LOWER, _WORDS, MAX_DIFFERENT_BITS, fingerprint, first_of_groups, near_links

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
#: A pair at 0.8 shares no band with a chance of (1 - 0.8 ** 5) ** 30, under 1 in 100,000.
BANDS, BAND_ROWS = 30, 5
SEED = 42
#: Of buckets over this size a leader is compared with all others, so many rounds.
SMALL, LEADER_ROUNDS = 8, 2
#: Members of a bucket that meet in one task once the leaders are through.
BUCKET_CAP = 256
_RNG = np.random.default_rng(SEED)
_ADD = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)
_MULTIPLY = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    return _WORDS.findall(text.translate(_LOWER))


def shingles(tokens: list[bytes], words: int = SHINGLE_WORDS) -> set[bytes]:
    """All runs of ``words`` words; a shorter text is one shingle, a text without words has none."""
    return {b" ".join(tokens[i : i + words]) for i in range(max(len(tokens) - words, 0) + 1)} if tokens else set()


def hashes_of(found: set[bytes]) -> np.ndarray:
    """Ordered 64-bit hashes of some shingles."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.searchsorted(b, a)
    same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return same / (len(a) + len(b) - same)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed key per band of minima over the shingles' hashes."""
    least = np.full(len(_ADD), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[k : k + 2048, None] ^ _ADD) * _MULTIPLY).min(axis=0))
    return [xxhash.xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(least.reshape(BANDS, BAND_ROWS))]


def signatures(rows: DataFrame, id_column: str, text_column: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """(row, h1, h2, n, fp, keys): a 128-bit hash of the words, the number of shingles, fingerprint and band keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            out = []
            for text in piece.column(1).cast(pa.binary()):
                data = text.as_py()
                tokens = words_of(data)
                found = hashes_of(shingles(tokens, words))
                whole = xxhash.xxh128_intdigest(b" ".join(tokens), SEED)
                code = int(np.uint64(fingerprint(data, words)).view(np.int64))
                out.append(((whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63), len(found), code, band_keys(found) if len(found) else []))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], names=["row", "h1", "h2", "n", "fp", "keys"])

    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    return rows.select(F.col(id_column).alias("row"), text).mapInArrow(tidy(run), "row long, h1 long, h2 long, n long, fp long, keys array<long>")


def index_pairs(classes: DataFrame, max_bits: int = MAX_DIFFERENT_BITS) -> DataFrame:
    """Pairs (src, dst) of ``first`` rows of ``classes`` that fingerprints of at most ``max_bits`` differing bits propose.

    Every class is paired with the first of its fingerprint, and those with the first of what the index links theirs to,
    so a large group of near copies proposes as many pairs as it has members.
    """
    codes = written(classes.where("n > 0").groupBy("fp").agg(F.min("first").alias("least")))
    links = written(near_links(codes.select("fp"), codes.count(), max_bits))
    same = classes.where("n > 0").join(codes, "fp").select(F.col("least").alias("src"), F.col("first").alias("dst"))
    ends = [codes.select(F.col("fp").alias(side), F.col("least").alias(f"{side}_row")) for side in ("src", "dst")]
    across = links.join(ends[0], "src").join(ends[1], "dst").select(F.least("src_row", "dst_row").alias("src"), F.greatest("src_row", "dst_row").alias("dst"))
    return written(same.union(across).where("src < dst").distinct())


def shingle_sets(texts: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(row, shingles): the ordered hashes of the shingles of every (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches, limit=1 << 21):
            each = [hashes_of(shingles(words_of(t.as_py()), words)).view(np.int64) for t in piece.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(each, pa.list_(pa.int64()))], names=["row", "shingles"])

    return texts.select("row", "text").mapInArrow(tidy(run), "row long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """Those (src, dst) of ``pairs`` whose shingles are as similar as ``least``, by the (row, shingles) of ``sets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([np.asarray(x.values).view(np.uint64) for x in batch.column(i)] for i in (2, 3))
            near = np.array([similarity(a, b) >= least for a, b in zip(one, two, strict=True)], bool)
            if near.any():
                yield batch.select(["src", "dst"]).filter(pa.array(near))

    one, two = (sets.select(F.col("row").alias(side), F.col("shingles").alias(f"{side}_set")) for side in ("src", "dst"))
    both = pairs.join(one, "src").join(two, "dst")
    return both.select("src", "dst", "src_set", "dst_set").mapInArrow(tidy(run), "src long, dst long")


def compared_in_place(opened: DataFrame, sets: DataFrame, signs: DataFrame, least: float = MIN_SIMILARITY, cap: int = BUCKET_CAP) -> DataFrame:
    """(src, dst) that join, in every bucket of ``opened`` (key, band, row, component), what is similar and not joined yet.

    The shingles go to the buckets, and all pairs of a bucket are compared there: no pair leaves its task but for the few
    that join something. A pair that an earlier band brought together, or whose sizes rule it out, is not compared.
    Buckets of more than ``cap`` rows are dealt into pairs of blocks.
    """
    order = ["key", "bi", "bj"]
    dealt = split_hot(opened.select("key", "band", "row", "component"), ["key"], F.col("row"), cap)
    placed = dealt.join(signs, "row").join(sets, "row").repartition(*order).sortWithinPartitions(*order, "row")

    def work(part: pa.Table, cross: bool) -> list[tuple[int, int]]:
        rows, blk = part.column("row").to_numpy(), part.column("blk").to_numpy()
        held = [np.asarray(x.values).view(np.uint64) for x in part.column("shingles").combine_chunks()]
        size = np.array([len(x) for x in held])
        band = part.column("band")[0].as_py()
        keys = np.array([x.values.to_numpy()[:band] for x in part.column("keys").combine_chunks()]).reshape(len(rows), band)
        _, group = np.unique(part.column("component").to_numpy(), return_inverse=True)
        joined = []
        for i in range(len(rows) - 1):
            may = (group[i + 1 :] != group[i]) & (np.minimum(size[i + 1 :], size[i]) >= (least - 1e-9) * np.maximum(size[i + 1 :], size[i]))
            if cross:
                may &= blk[i + 1 :] != blk[i]
            may = np.flatnonzero(may) + i + 1
            if band and len(may):
                may = may[~(keys[may] == keys[i]).any(axis=1)]
            for j in may.tolist():
                if group[i] != group[j] and similarity(held[i], held[j]) >= least:
                    joined.append((int(rows[i]), int(rows[j])))
                    group[group == group[j]] = group[i]
        return joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, order, cap):
            begins = starts_of(part, order)
            cross = part.column("bi").to_numpy() != part.column("bj").to_numpy()
            out = [pair for a, b in zip(begins.tolist(), [*begins[1:].tolist(), part.num_rows], strict=True) if b - a > 1 for pair in work(part.slice(a, b - a), bool(cross[a]))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in out]), pa.array([max(p) for p in out])], names=["src", "dst"])

    return placed.select(*order, "row", "band", "component", "blk", "keys", "shingles").mapInArrow(tidy(run), "src long, dst long")


def similar_links(buckets: DataFrame, sets: DataFrame, signs: DataFrame, links: DataFrame | None = None, least: float = MIN_SIMILARITY, small: int = SMALL, rounds: int = LEADER_ROUNDS, cap: int = BUCKET_CAP) -> DataFrame | None:
    """(node, component) of the rows of ``buckets`` (key, band, row, n) that pairs of at least ``least`` join.

    ``sets`` (row, shingles) and ``signs`` (row, keys) describe the rows. Pairs already in one component, by ``links`` to begin with, are not compared. In a large bucket one leader a round is compared
    with all members outside its component, so a large group of copies costs about one comparison a
    member; what stays apart after ``rounds`` of them, and small buckets, are compared where they meet.
    """
    star = None if links is None else written(components(links))
    for step in range(rounds + 1):
        members = buckets.withColumn("component", F.col("row"))
        if star is not None:
            members = buckets.join(star.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
        members = written(members)
        size = members.groupBy("key").agg(
            F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by(F.struct("row", "component", "n"), F.xxhash64("row", F.lit(step))).alias("leader"),
        ).where("low < high").select("key", "size", "leader")
        size = written(size)
        opened = members.join(size, "key")
        if step == rounds:
            pairs = compared_in_place(opened, sets, signs, least, cap)
        else:
            led = opened.where((F.col("size") > small) & (F.col("component") != F.col("leader.component")))
            led = led.select(F.col("leader.row").alias("a"), F.col("leader.n").alias("an"), F.col("row").alias("b"), F.col("n").alias("bn")).where(F.least("an", "bn") >= F.lit(least - 1e-9) * F.greatest("an", "bn"))
            pairs = verified(written(led.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()), sets, least)
        fresh = written(pairs)
        links = written(fresh if links is None else links.union(fresh))
        star = written(components(links))
        drop_written(members)
    return star


def similar_groups(rows: DataFrame, id_column: str, text_column: str = "text", words: int = SHINGLE_WORDS, least: float = MIN_SIMILARITY, **limits: int) -> DataFrame:
    """(row, component) of every row: rows joined by chains of pairs at least as similar as ``least``.

    ``id_column`` numbers the rows. Texts of the same words are one class and compared once; all texts
    without words are one class.
    """
    signed = written(signatures(rows, id_column, text_column, words))
    classes = written(signed.groupBy("h1", "h2").agg(F.min("row").alias("first"), F.any_value("n").alias("n"), F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys")))
    bands = written(classes.select(F.col("first").alias("row"), "n", F.posexplode("keys").alias("band", "key")))
    shared = written(bands.groupBy("key").count().where("count > 1").select("key"))
    buckets = written(bands.join(shared, "key").select("key", "band", "row", "n"))
    drop_written(bands)
    proposed = index_pairs(classes)
    wanted = buckets.select("row").union(proposed.select("src")).union(proposed.select("dst"))
    wanted = written(wanted.distinct())
    texts = rows.select(F.col(id_column).alias("row"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    signs = classes.select(F.col("first").alias("row"), "keys")
    with small_batches(rows.sparkSession):
        sets = written(shingle_sets(texts.join(wanted, "row", "left_semi"), words))
        star = similar_links(buckets, sets, signs, written(verified(proposed, sets, least)), least, **limits)
    named = classes.select("h1", "h2", "first")
    if star is not None:
        named = named.join(star.withColumnRenamed("node", "first"), "first", "left").select("h1", "h2", F.coalesce("component", "first").alias("first"))
    named = written(named)
    return signed.select("row", "h1", "h2").join(named, ["h1", "h2"]).select("row", F.col("first").alias("component"))


def keep_dissimilar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS, least: float = MIN_SIMILARITY, **limits: int) -> DataFrame:
    """``docs`` with one row of every group of similar texts: the one of the smallest id, null ids last.

    Null texts count as empty; all texts without words are one group. Repeated rows are one group, no rows give none.
    """
    row, group = unused(docs.columns, "row", "group")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = similar_groups(rows, row, text_column, words, least, **limits).toDF(row, group)
    return first_of_groups(rows, groups, row, group, id_column).select(*docs.columns)
