"""Removal of long byte strings that occur twice, by column-wise suffix sorting of many documents.

A string of WINDOW bytes holds the same minimiser (the least hashed short string inside it, leftmost of
equals) at the same place wherever it occurs, so equal strings meet under the hash of their minimiser.
For every run of window starts with one minimiser a row of hashes leaves the scan, no text. Runs whose
whole segments are equal are settled by that; other runs that share a minimiser are cut into pieces of
few windows, compared the same way by all bytes their windows share. Pieces that share these but differ
around them become short strings, what they share being one symbol, and are gathered into collections
whose Burrows-Wheeler transform and common-prefix array are built column by column, one symbol of every
piece per round. A window repeats where a neighbour in that order has the same symbols all through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import drop_written, runs, starts_of, table, text_pieces, written

WINDOW = 400
#: Bytes of the strings among which the minimiser is chosen.
GRAM = 100
#: Words of a passage that is reported if it stands in two places, and of the strings among which its minimiser is chosen.
PASSAGE_WORDS, PASSAGE_GRAM = 50, 8
#: Windows of words that are compared together before each is compared by itself.
PASSAGE_STEP = 8
#: Windows of a piece.
PIECE_WINDOWS = 32
#: Different pieces with one key that one collection takes; of more, each window is compared by itself.
COLLECTION_CAP = 1500
#: Segments that make up a collection; whole groups are added until it has so many.
COLLECTION_ROWS = 1024
SCAN_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 31) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class Prefixes:
    """Hash of any substring of some bytes in constant time."""

    _up, _down = _powers(1 << 10)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Prefixes._up) < n:
            Prefixes._up, Prefixes._down = _powers(max(n, SCAN_BYTES + 2 * WINDOW))
        sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: n - 1], out=sums[1:])
        self.sums = sums

    def raw(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self._down[at]

    def grams(self, size: int) -> np.ndarray:
        """Of all substrings of one size."""
        return _mixed((self.sums[size:] - self.sums[:-size]) * self._down[: len(self.sums) - size])

    def of(self, at: np.ndarray, size: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        return _mixed(self.raw(at, size) ^ _mixed(np.asarray(size, np.uint64) * _BASE + np.asarray(salt, np.uint64)))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def minimiser_runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(core hash, segment hash, anchor, first window, last window) of runs, in positions of ``data``.

    ``offsets`` bounds the documents; no window crosses a bound. Works in blocks of bounded size, at
    whose ends a run may be cut in two.
    """
    total = len(data)
    for s in range(0, total - window + 1, SCAN_BYTES):
        e = min(s + SCAN_BYTES, total - window + 1)
        block = data[s : e + window - 1]
        crossing = np.zeros(e - s + 1, np.int32)
        first = np.searchsorted(offsets, s, side="right")
        ends = offsets[first : np.searchsorted(offsets, e + window, side="right")]
        np.add.at(crossing, np.clip(ends - window + 1 - s, 0, e - s), 1)
        np.add.at(crossing, np.clip(ends - s, 0, e - s), -1)
        valid = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
        if not len(valid):
            continue
        prefix = Prefixes(block)
        grams = prefix.grams(gram)
        places = np.arange(len(grams), dtype=np.uint64)
        least = window_minima((grams & ~_PLACE) | places, window - gram + 1)[valid]
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        lo, hi = valid[np.concatenate(([0], cut))], valid[np.concatenate((cut - 1, [len(valid) - 1]))]
        anchor = (least[np.concatenate(([0], cut))] & _PLACE).astype(np.int64)
        seg = prefix.of(lo, hi - lo + window, anchor - lo)
        yield grams[anchor].view(np.int64), seg.view(np.int64), anchor + s, lo + s, hi + s


OCCURRENCES = "core long, seg long, k1 long, k2 long, doc_id long, anchor int, lo int, hi int"


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text and a 128-bit key of the text: equal texts are one text to all later steps."""
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    got = docs.select(F.col(id_column).cast("long").alias("doc_id"), text)
    return got.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words(dict):
    """Numbers of words; equal words have equal numbers in every worker, different ones by a 64-bit hash different ones."""

    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh64_intdigest(word, 7)
        if len(word) <= 64:
            if len(self) >= 500_000:
                self.clear()
            self[word] = got
        return got

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def _words() -> Words:
    return Words()


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    each = [_words().of(t.as_py()) for t in column.cast(pa.large_binary())]
    return np.concatenate([np.zeros(0, np.uint64), *each]), np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)


def scan(docs: DataFrame, window: int, gram: int, words: bool = False) -> DataFrame:
    """Runs of windows with one minimiser, of all texts of ``keyed`` documents, over their bytes or their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            data, offsets = (_words_of if words else _bytes_of)(piece.column(1))
            k1, k2 = piece.column(2).to_numpy(), piece.column(3).to_numpy()
            for core, seg, anchor, lo, hi in minimiser_runs(data, offsets, window, gram):
                doc = np.searchsorted(offsets, lo, side="right") - 1
                base = offsets[doc]
                places = [pa.array((x - base).astype(np.int32)) for x in (anchor, lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core), pa.array(seg), pa.array(k1[doc]), pa.array(k2[doc]), piece.column(0).take(pa.array(doc)), *places],
                    names=["core", "seg", "k1", "k2", "doc_id", "anchor", "lo", "hi"],
                )

    return docs.select("doc_id", "text", "k1", "k2").mapInArrow(run, OCCURRENCES)


def classify(occurrences: DataFrame) -> DataFrame:
    """Occurrences whose core occurs more than once, with what is known of their segment.

    repeated: the whole segment occurs elsewhere. rivals: number of different segments under the core.
    first: this occurrence stands for its segment. All sums are of fixed size per key, so a core with a
    third of all occurrences is summed before the shuffle. The sums are written tables: both sides of
    every join are then plain shuffles, which the adaptive skew join can split. A table is removed, ``occurrences`` if
    it is a written one too, once the table made of it is there.
    """
    o = F.xxhash64("k1", "k2", "lo")
    both = occurrences.groupBy("core").agg(F.min(o).alias("a"), F.max(o).alias("b")).where("a <> b").select("core")
    both = written(both)
    rows = written(occurrences.join(both, "core", "left_semi").withColumn("o", o))
    for done in (occurrences, both):
        drop_written(done)
    segs = written(rows.groupBy("core", "seg").agg(F.min("o").alias("least"), F.max("o").alias("most")))
    rivals = written(segs.groupBy("core").agg(F.count("*").alias("rivals")))
    got = rows.join(segs, ["core", "seg"]).join(rivals, "core")
    got = written(got.selectExpr(
        "core", "seg", "k1", "k2", "doc_id", "anchor", "lo", "hi", "rivals",
        "least <> most AS repeated", "o = least AS first",
    ))
    for done in (rows, segs, rivals):
        drop_written(done)
    return got


def with_texts(texts: DataFrame, wanted: DataFrame, fields: list[str]) -> DataFrame:
    """(k1, k2, text, at): for each text the places asked for, as one list."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct(*fields)).alias("at"))
    return texts.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "at")


def finer(texts: DataFrame, crowded: DataFrame, step: int, window: int, words: bool = False) -> DataFrame:
    """Occurrences anew, keyed by all bytes that windows at ``step`` neighbouring offsets share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches, limit=SCAN_BYTES):
            data, offsets = (_words_of if words else _bytes_of)(piece.column(2))
            at = piece.column(3)
            text = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
            part, base = at.flatten(), offsets[text]
            anchor, lo, hi = (part.field(n).to_numpy().astype(np.int64) + base for n in ("anchor", "lo", "hi"))
            core = part.field("core").to_numpy()
            # places are counted over all texts of the piece; no window leaves its text
            j0, j1 = (anchor - hi) // step, (anchor - lo) // step
            n = j1 - j0 + 1
            who = np.repeat(np.arange(len(n)), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + j0[who]
            begin = np.maximum(lo[who], anchor[who] - j * step - step + 1)
            end = np.minimum(hi[who], anchor[who] - j * step)
            prefix = Prefixes(data)
            salt = core[who].view(np.uint64) + j.astype(np.uint64)
            keys = prefix.of(anchor[who] - j * step, np.full(len(j), window - step + 1), salt)
            segs = prefix.of(begin, end - begin + window, anchor[who] - begin)
            own = text[who]
            names = [piece.column(i).take(pa.array(own)) for i in (0, 1)]
            places = [pa.array((x - offsets[own]).astype(np.int32)) for x in (anchor[who], begin, end)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(segs.view(np.int64)), *names, pa.nulls(len(j), pa.int64()), *places],
                names=["core", "seg", "k1", "k2", "doc_id", "anchor", "lo", "hi"],
            )

    wanted = with_texts(texts, crowded, ["core", "anchor", "lo", "hi"])
    return wanted.select("k1", "k2", "text", "at").mapInArrow(run, OCCURRENCES)


def column_sort(segments: list[np.ndarray], least: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Transform, common prefixes, segment and suffix length of all suffixes of a collection, in order.

    Round t puts the suffix of length t of every segment that has one in its place: the symbol before
    the suffix put in last is looked up in the transform so far, and its rank there is the place of the
    longer suffix. The common prefix with the neighbours on either side is one more than the least
    common prefix between the two places of that symbol. An end mark, symbol 0, precedes all others;
    marks of different segments differ. Only suffixes of ``least`` symbols or more are returned.
    """
    n = len(segments)
    size = np.array([len(s) for s in segments])
    flat = np.concatenate(segments) if n else np.zeros(0, np.uint16)
    ends = np.cumsum(size)
    width = np.int16 if size.max(initial=0) < 30_000 else np.int32

    def symbol(who: np.ndarray, t: int) -> np.ndarray:
        """Symbol before the suffix of length t; 0, which no segment holds, at the start of the segment."""
        inside = size[who] > t
        out = np.zeros(len(who), np.uint16)
        out[inside] = flat[ends[who[inside]] - t - 1]
        return out

    active = np.arange(n)
    bwt = symbol(active, 0)
    common = np.zeros(n, width)
    tag = np.arange(n, dtype=np.int64) << 32
    at = np.flatnonzero(bwt)
    active = active[bwt > 0]
    ended = n - len(at)
    t = 0
    while len(active):
        t += 1
        m = len(bwt)
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(m, np.int32)
        rank[order] = np.arange(m, dtype=np.int32)
        r = rank[at]
        s = bwt[at]
        back, ahead = order[r - 1], order[np.minimum(r + 1, m - 1)]
        has_back = (r > 0) & (bwt[back] == s)
        has_ahead = (r + 1 < m) & (bwt[ahead] == s)
        before, after = np.zeros(len(at), width), np.zeros(len(at), width)
        before[has_back] = 1 + _least_between(common, back[has_back] + 1, at[has_back])
        after[has_ahead] = 1 + _least_between(common, at[has_ahead] + 1, ahead[has_ahead])
        place = r.astype(np.int64) + (n - ended)
        total = m + len(place)
        old = np.ones(total, bool)
        old[place] = False
        old = np.flatnonzero(old)
        fresh = symbol(active, t)
        grown = []
        for held, new in ((bwt, fresh), (common, before), (tag, (active << 32) + t)):
            out = np.empty(total, held.dtype)
            out[old] = held
            out[place] = new
            grown.append(out)
        bwt, common, tag = grown
        follow = place + 1 < total
        common[place[follow] + 1] = after[follow]
        going = fresh > 0
        ended += len(going) - int(going.sum())
        active, at = active[going], place[going]
    owner, length = tag >> 32, tag & 0xFFFFFFFF
    if least:
        # what stays between two suffixes is the least of all common prefixes between their places
        keep = np.flatnonzero(length >= least)
        between = _least_between(common, keep[:-1] + 1, keep[1:]) if len(keep) > 1 else common[:0]
        common = np.concatenate((np.zeros(min(1, len(keep)), common.dtype), between))
        bwt, owner, length = bwt[keep], owner[keep], length[keep]
    return bwt, common, owner, length


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first..last] for each pair, first <= last."""
    if not len(first):
        return np.zeros(0, values.dtype)
    bounds = np.empty(2 * len(first), np.int64)
    bounds[0::2], bounds[1::2] = first, last + 1
    padded = np.append(values, values.dtype.type(0))
    return np.minimum.reduceat(padded, bounds)[0::2]


def repeated_starts(segments: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each segment the starts of ``window`` symbols that occur elsewhere in the collection."""
    _, common, owner, length = column_sort(segments, window)
    twice = common >= window
    if len(twice):
        twice[0] = False
    hit = twice.copy()
    hit[:-1] |= twice[1:]
    owner, length = owner[hit], length[hit]
    order = np.argsort(owner, kind="stable")
    owner, length = owner[order], length[order]
    cuts = np.searchsorted(owner, np.arange(len(segments) + 1))
    return [np.sort(len(s) - length[a:b]) for s, a, b in zip(segments, cuts[:-1], cuts[1:], strict=True)]


def _ranges(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return starts[np.concatenate(([0], cut))], starts[np.concatenate((cut - 1, [len(starts) - 1]))]


def symbols(before: bytes, core: int, after: bytes) -> np.ndarray:
    """A piece as a string: bytes as 1 to 256, what its group shares as the symbol 257 + ``core``."""
    out = np.empty(len(before) + 1 + len(after), np.uint16)
    out[: len(before)] = np.frombuffer(before, np.uint8)
    out[len(before) + 1 :] = np.frombuffer(after, np.uint8)
    out += np.uint16(1)
    out[len(before)] = 257 + core
    return out


def compare_columns(texts: DataFrame, mixed: DataFrame, step: int, window: int) -> DataFrame:
    """(k1, k2, lo, hi): window starts of ``mixed`` pieces that repeat within their group.

    A window of a piece is its core, one symbol, and step - 1 bytes before and after it together, so a
    window is ``step`` symbols long wherever it starts.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            out: list[list] = [[], [], [], [], [], [], []]
            for k1, k2, text, at in zip(*(piece.column(i).to_pylist() for i in range(4)), strict=True):
                data = text.encode()
                for x in at:
                    begin = x["anchor"] - (x["anchor"] - x["lo"]) // step * step
                    end = begin - step + 1 + window
                    for held, value in zip(out, (x["core"], x["repeated"], k1, k2, x["lo"], data[x["lo"] : begin], data[end : x["hi"] + window]), strict=True):
                        held.append(value)
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=["core", "repeated", "k1", "k2", "lo", "before", "after"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["core"], COLLECTION_ROWS * 16):
            begins = np.append(starts_of(part, ["core"]), part.num_rows)
            group = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
            settled = part.column("repeated").to_numpy()
            k1, k2, lo = (part.column(c).to_numpy() for c in ("k1", "k2", "lo"))
            before, after = part.column("before").to_pylist(), part.column("after").to_pylist()
            rows: list[list] = [[], [], [], []]
            a = 0
            while a < part.num_rows:
                b = int(begins[np.searchsorted(begins, min(a + COLLECTION_ROWS, part.num_rows))])
                found = repeated_starts([symbols(before[i], int(group[i] - group[a]), after[i]) for i in range(a, b)], step)
                for i, starts in enumerate(found, a):
                    if len(starts) and not settled[i]:
                        for x, y in zip(*(v.tolist() for v in _ranges(starts)), strict=True):
                            for held, value in zip(rows, (k1[i], k2[i], lo[i] + x, lo[i] + y), strict=True):
                                held.append(int(value))
                a = b
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["k1", "k2", "lo", "hi"])

    lists = with_texts(texts, mixed, ["core", "repeated", "anchor", "lo", "hi"])
    pieces = lists.mapInArrow(cut, "core long, repeated boolean, k1 long, k2 long, lo int, before binary, after binary")
    placed = pieces.repartition("core").sortWithinPartitions("core", "k1", "k2", "lo")
    return placed.mapInArrow(sort, "k1 long, k2 long, lo int, hi int")


def owned_texts(texts: DataFrame, level: DataFrame) -> DataFrame:
    """(k1, k2, text) of the texts that ``level`` names, one row each."""
    # the id is a key of the join, so the copies of one text do not meet in one task
    owners = level.groupBy(F.col("k1").alias("o1"), F.col("k2").alias("o2")).agg(F.min("doc_id").alias("owner"))
    own = (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")) & F.col("doc_id").eqNullSafe(F.col("owner"))
    return written(texts.join(owners, own).select("k1", "k2", "text"))


def repeated_passages(texts: DataFrame, words: int = PASSAGE_WORDS, gram: int = PASSAGE_GRAM) -> DataFrame:
    """(k1, k2, n_words): words of ``keyed`` texts inside a string of ``words`` words that starts anywhere else too.

    White space tells words apart and counts for nothing else. The runs that only share a minimiser are settled
    in pieces, then window by window; a window has few words, so no transform is built over them.
    """
    level = classify(written(scan(texts, words, gram, True)))
    found = ["k1", "k2", "lo", "hi"]
    spans = level.where("repeated").select(found)
    held = None
    for step in (PASSAGE_STEP, 1):
        open_runs = level.where("first AND rivals > 1")
        held = held or owned_texts(texts, open_runs)
        level = classify(written(finer(held, open_runs, step, words, True)))
        spans = spans.unionByName(level.where("repeated").select(found))
    spans = spans.distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for at in batch.column(2):
                lo, hi = (at.values.field(n).to_numpy().astype(np.int64) for n in ("lo", "hi"))
                order = np.argsort(lo, kind="stable")
                lo, end = lo[order], np.maximum.accumulate(hi[order]) + words
                sizes.append(int((end - np.maximum(lo, np.concatenate(([0], end[:-1])))).clip(0).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["k1", "k2", "n_words"])

    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("at"))
    return lists.mapInArrow(count, "k1 long, k2 long, n_words long")


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM, cap: int = COLLECTION_CAP) -> DataFrame:
    """Keyed texts, the distinct texts of them that may hold repeats, and the window starts (k1, k2, lo, hi) that repeat."""
    texts = keyed(docs, id_column, text_column)
    level = classify(written(scan(texts, window, gram)))
    held = owned_texts(texts, level)
    found = ["k1", "k2", "lo", "hi"]
    spans = level.where("repeated").select(found)
    # pieces of few windows: most of what differs as a whole run is equal or alone as a piece
    level = classify(finer(held, level.where("first AND rivals > 1"), PIECE_WINDOWS, window))
    spans = spans.unionByName(level.where("repeated").select(found))
    spans = spans.unionByName(compare_columns(held, level.where(f"first AND rivals BETWEEN 2 AND {cap}"), PIECE_WINDOWS, window))
    crowded = level.where(f"first AND rivals > {cap}")
    if not crowded.isEmpty():
        single = classify(finer(held, crowded, 1, window))
        spans = spans.unionByName(single.where("repeated").select(found))
    return texts, held, written(spans.distinct())


def removed_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM, cap: int = COLLECTION_CAP, words: int = PASSAGE_WORDS, words_gram: int = PASSAGE_GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated_words, spans (byte ranges removed).

    n_repeated_words counts the words in passages of ``words`` words or more that stand in two places; it removes
    nothing, since in bytes such a passage can be shorter than ``window``. A null text is empty. Documents under ``window`` bytes lose nothing. Rows with equal texts of at
    least ``window`` bytes lose all of it, however often they occur. Texts are told apart by a 128-bit
    hash, segments under one core by a 64-bit hash with their place.
    """
    texts, held, spans = repeated_spans(docs, id_column, text_column, window, gram, cap)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            out: list[list] = [[], [], [], [], [], []]
            for k1, k2, text, at in zip(*(piece.column(i).to_pylist() for i in range(4)), strict=True):
                data = text.encode()
                merged: list[list[int]] = []
                for a, b in sorted((x["lo"], x["hi"] + window) for x in at):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                kept, done = hashlib.sha256(), 0
                for a, b in merged:
                    kept.update(data[done:a])
                    done = b
                kept.update(data[done:])
                row = (k1, k2, sum(b - a for a, b in merged), len(merged), kept.hexdigest(), [{"start": a, "end": b} for a, b in merged])
                for x, value in zip(out, row, strict=True):
                    x.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=["k1", "k2", "n_removed", "n_spans", "kept", "spans"])

    changed = with_texts(held, spans, ["lo", "hi"]).mapInArrow(
        cut, "k1 long, k2 long, n_removed long, n_spans long, kept string, spans array<struct<start:long,end:long>>"
    )
    size = F.octet_length("text").cast("long")
    own_words = F.size(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).cast("long")
    slim = texts.select("doc_id", "k1", "k2", size.alias("n_bytes"), own_words.alias("size"), F.sha2(F.encode("text", "UTF-8"), 256).alias("whole"))
    copies = slim.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2", F.lit(True).alias("copied"))
    passages = repeated_passages(texts, words, words_gram)
    got = slim.join(written(changed.join(copies, ["k1", "k2"], "full").join(passages, ["k1", "k2"], "full")), ["k1", "k2"], "left")
    copied = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= window)
    again = F.coalesce("copied", F.lit(False)) & (F.col("size") >= words)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return got.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        F.when(again, F.col("size")).otherwise(F.coalesce("n_words", F.lit(0))).alias("n_repeated_words"),
        F.when(copied, everything).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("spans"),
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_bytes(table(spark, sf_dir, "documents")).drop("spans")
