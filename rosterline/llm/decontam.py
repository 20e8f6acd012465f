"""Benchmark decontamination: BM25 over test items with block-max WAND, then an overlap check.

The index holds the test items, cut into units; every passage of the corpus is a query. Weights are BM25
divided by what a unit scores against itself, so one threshold fits all units: a passage that holds a
whole unit scores 1.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import table, text_pieces, tidy

#: Words of a unit at most; a passage is twice as long and starts every so many words, so it holds any unit whole.
UNIT_WORDS = 64
THRESHOLD = 0.6
SHINGLE_WORDS = 5
#: Least shares of an item's word shingles found near the passage: of all, of its question, of its answer.
OVERLAP, QUESTION_OVERLAP, ANSWER_OVERLAP = 0.8, 0.5, 0.5
#: Share of an item's words, at its end, that counts as the answer.
ANSWER_SHARE = 0.25
#: Words of test items that one index, and so one broadcast, holds; larger benchmarks take several passes.
INDEX_WORDS = 2_000_000
BLOCK = 16
K1, B = 1.2, 0.75
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…“”„‘’«»"
_CACHE = 200_000


def normal(word: str) -> str:
    return word.lower().strip(_MARKS)


class Index:
    """Inverted lists with the largest weight per list and per block of postings."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        units: list[tuple[int, list[int]]] = []
        for item, text in items:
            words = [w for w in map(normal, (text or "").split()) if w]
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if not ids:
                continue
            self.items.append((item, np.array(ids, np.int32)))
            # units of nearly equal size, so that no item leaves a tail of a word or two that any text holds
            n = -(-len(ids) // UNIT_WORDS)
            units += [(len(self.items) - 1, ids[k * len(ids) // n : (k + 1) * len(ids) // n]) for k in range(n)]
        self.unit_item = np.array([k for k, _ in units], np.int32)
        lists: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        seen = Counter(t for _, ids in units for t in set(ids))
        mean = sum(len(ids) for _, ids in units) / max(len(units), 1)
        for u, (_, ids) in enumerate(units):
            raw = {}
            for t, f in Counter(ids).items():
                idf = math.log(1 + (len(units) - seen[t] + 0.5) / (seen[t] + 0.5))
                raw[t] = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * len(ids) / mean))
            whole = sum(raw.values())
            for t, w in raw.items():
                lists[t].append((u, w / whole))
        self.docs = [np.array([u for u, _ in x], np.int32) for x in lists]
        self.weights = [np.array([w for _, w in x]) for x in lists]
        self.top = [float(w.max()) for w in self.weights]
        self.block_max = [np.maximum.reduceat(w, np.arange(0, len(w), BLOCK)) for w in self.weights]
        self.n_units = len(units)
        #: the same as lists, which are quicker to step through one by one
        self.walk = [(d.tolist(), w.tolist(), b.tolist()) for d, w, b in zip(self.docs, self.weights, self.block_max, strict=True)]
        self._divide()

    def _divide(self) -> None:
        """Sets apart the longest lists that together give no unit over half the threshold.

        A unit over the threshold then has the rest from its other, telling terms; the lists of those
        are what most passages are ruled out by.
        """
        common = np.zeros(self.n_units)
        self.telling = np.ones(len(self.docs), bool)
        for t in sorted(range(len(self.docs)), key=lambda t: (-len(self.docs[t]), t)):
            after = common[self.docs[t]] + self.weights[t]
            if (after > self.threshold / 2).any():
                continue
            common[self.docs[t]] = after
            self.telling[t] = False
        self.needed = self.threshold - common - 1e-9
        size = np.array([len(d) if self.telling[t] else 0 for t, d in enumerate(self.docs)], np.int64)
        self.size, self.begin = size, np.cumsum(size) - size
        own = [t for t in range(len(self.docs)) if self.telling[t]]
        self.flat_docs = np.concatenate([self.docs[t] for t in own]) if own else np.zeros(0, np.int32)
        self.flat_weights = np.concatenate([self.weights[t] for t in own]) if own else np.zeros(0)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All units that score at least the threshold against the distinct ``terms``, by block-max WAND."""
        least = self.threshold - 1e-9
        found = []
        walk, top = self.walk, self.top
        at = {t: 0 for t in terms if walk[t][0]}
        while True:
            live = sorted((walk[t][0][p], t) for t, p in at.items())
            total, pivot = 0.0, -1
            for i, (_, t) in enumerate(live):
                total += top[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                return found
            unit = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == unit:
                pivot += 1
            bound, nearest = 0.0, live[pivot + 1][0] if pivot + 1 < len(live) else self.n_units
            for _, t in live[: pivot + 1]:
                docs, _, blocks = walk[t]
                p = bisect_left(docs, unit, at[t])
                if p < len(docs):
                    bound += blocks[p // BLOCK]
                    last = docs[min((p // BLOCK + 1) * BLOCK, len(docs)) - 1]
                    nearest = min(nearest, last + 1)
            if bound < least:
                to = max(nearest, unit + 1)
            elif live[0][0] == unit:
                score = sum(walk[t][1][at[t]] for d, t in live if d == unit)
                if score >= least:
                    found.append((unit, score))
                to = unit + 1
            else:
                to = unit
            for d, t in live[: pivot + 1]:
                if d < to:
                    p = bisect_left(walk[t][0], to, at[t])
                    if p < len(walk[t][0]):
                        at[t] = p
                    else:
                        del at[t]


class _Ids(dict):
    """Term of each raw word: -1 for words the items lack, -2 for marks alone."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        plain = normal(word)
        got = self.vocabulary.get(plain, -1) if plain else -2
        if len(word) <= 64:
            if len(self) >= _CACHE:
                self.clear()
            self[word] = got
        return got


def _shingles(ids: np.ndarray, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all shingles; shorter sequences are one shingle."""
    words = min(words, len(ids))
    value = np.zeros(max(len(ids) - words + 1, 0), np.uint64)
    for k in range(words):
        value = value * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + len(value)].astype(np.int64) + 3).astype(np.uint64)
    return value


class Matcher:
    """Leaks in texts, for one index."""

    def __init__(self, index: Index):
        self.index, self.ids = index, _Ids(index.vocabulary)
        self.parts = []
        for _, ids in index.items:
            all_of = _shingles(ids)
            cut = len(ids) - max(1, round(ANSWER_SHARE * len(ids)))
            # a shingle belongs to the answer if it ends there
            ends = np.arange(len(all_of)) + min(SHINGLE_WORDS, len(ids)) - 1
            self.parts.append((all_of, ends >= cut))

    def terms(self, text: str) -> np.ndarray:
        words = text.split()
        got = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        return got[got != -2]

    def suspects(self, ids: np.ndarray, segment: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Passages (by their first segment) whose telling terms alone do not rule out every unit.

        ``last``: for each segment whether it is the first of its document, so no passage reaches back.
        """
        index = self.index
        hit = np.flatnonzero(ids >= 0)
        hit = hit[index.telling[ids[hit]]]
        t, seg = ids[hit], segment[hit]
        n = index.size[t]
        who = np.repeat(np.arange(len(t)), n)
        post = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + index.begin[t][who]
        unit, weight = index.flat_docs[post].astype(np.int64), index.flat_weights[post]
        own = seg[who].astype(np.int64)
        back = ~last[own]
        key = np.concatenate((own, own[back] - 1)) * index.n_units + np.concatenate((unit, unit[back]))
        weight = np.concatenate((weight, weight[back]))
        if not len(key):
            return key
        keys, inverse = np.unique(key, return_inverse=True)
        mass = np.bincount(inverse, weights=weight)
        return np.unique(keys[mass >= index.needed[keys % index.n_units]] // index.n_units)

    def leaks(self, texts: list[str]) -> list[tuple[int, int, float, float, float, float, int]]:
        """(text number, item, score, overlap, question and answer overlap, first word) of the leaks in some texts."""
        if not self.index.n_units:
            return []
        each = [self.terms(x) for x in texts]
        size = np.array([len(x) for x in each])
        segments = -(-size // UNIT_WORDS)
        begin = np.cumsum(segments) - segments
        total = int(segments.sum())
        if not total:
            return []
        ids = np.concatenate(each)
        doc = np.repeat(np.arange(len(texts)), size)
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        first = np.zeros(total, bool)
        first[begin[segments > 0]] = True
        found: dict[tuple[int, int], tuple] = {}
        for passage in self.suspects(ids, begin[doc] + inside // UNIT_WORDS, first).tolist():
            k = int(np.searchsorted(begin, passage, side="right")) - 1
            start = (passage - int(begin[k])) * UNIT_WORDS
            words = each[k][start : start + 2 * UNIT_WORDS]
            terms = np.unique(words[words >= 0]).tolist()
            for unit, score in self.index.search(terms):
                number = int(self.index.unit_item[unit])
                item, own = self.index.items[number]
                near = each[k][max(0, start - len(own)) : start + 2 * UNIT_WORDS + len(own)]
                all_of, answer = self.parts[number]
                there = np.isin(all_of, _shingles(near, min(SHINGLE_WORDS, len(own)))) if len(near) >= min(SHINGLE_WORDS, len(own)) else np.zeros(len(all_of), bool)
                share = [float(x.mean()) if len(x) else 1.0 for x in (there, there[~answer], there[answer])]
                if share[0] >= OVERLAP and share[1] >= QUESTION_OVERLAP and share[2] >= ANSWER_OVERLAP:
                    row = (share[0], score, share[1], share[2], -start)
                    if row > found.get((k, item), ()):
                        found[k, item] = row
        return [(k, item, s, o, q, a, -w) for (k, item), (o, s, q, a, w) in sorted(found.items())]


LEAKS = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double, first_word long"


def _indexes(benchmark: DataFrame, item_column: str, item_text: str, threshold: float, index_words: int) -> Iterator:
    """Broadcast indexes that together hold the benchmark, each of about ``index_words`` words at most."""
    items = benchmark.select(F.col(item_column).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    count = max(1, math.ceil(words / index_words))
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).orderBy("item", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r["item"], r["text"]) for r in part], threshold))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, index_words: int = INDEX_WORDS) -> DataFrame:
    """One row per document row and test item that leaks into it.

    Null and empty texts leak nothing, and items without words are found nowhere. The best passage of a
    pair is reported, the earliest of equals. Repeated rows are reported as often as they occur. The
    benchmark is dealt into indexes of at most about ``index_words`` words, so what is broadcast is bounded;
    every index sees all documents.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text)
    found = None
    for index in _indexes(benchmark, item_column, item_text, threshold, index_words):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(index.value)
            for piece in text_pieces(batches, limit=1 << 21):
                got = matcher.leaks(piece.column(1).to_pylist())
                if got:
                    ids = piece.column(0).take(pa.array([r[0] for r in got]))
                    rest = [pa.array([r[i] for r in got], t) for i, t in ((1, pa.int64()), *((i, pa.float64()) for i in range(2, 6)), (6, pa.int64()))]
                    names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "first_word"]
                    yield pa.RecordBatch.from_arrays([ids, *rest], names=names)

        more = rows.mapInArrow(tidy(run), LEAKS)
        found = more if found is None else found.unionByName(more)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, index_words: int = INDEX_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, into which no test item leaks.

    Null and empty texts hold no item and stay. Repeated rows are judged alike. No documents give no rows, no items keep all.
    """
    at = docs.columns.index(text_column)
    kept = docs
    for index in _indexes(benchmark, item_column, item_text, threshold, index_words):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(index.value)
            for piece in text_pieces(batches, text_column, limit=1 << 21):
                clean = np.ones(piece.num_rows, bool)
                clean[[r[0] for r in matcher.leaks([t or "" for t in piece.column(at).to_pylist()])]] = False
                yield piece.filter(pa.array(clean))

        kept = kept.mapInArrow(tidy(run), docs.schema)
    return kept


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
