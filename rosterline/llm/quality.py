"""Ordinal cumulative-link regression of graded ratings on hashed text.

One weight per hashed feature is shared by all grades; ordered thresholds cut the weighted sum into
grades: P(grade <= k) = sigmoid(threshold_k - sum). That gives an expected grade and the probability of
the upper grades, on which documents are selected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import kept, table, text_pieces, tidy, unused

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 18, 1 << 12
#: Labelled rows the model is fitted on at most; which ones, a hash of the id decides.
FIT_ROWS = 12_000
#: A document is kept from this probability of the highest grade on.
MIN_TAIL = 0.5
ROUNDS, RATE, PENALTY = 200, 0.1, 0.3
#: Features of a smaller share of the fitted rows get no weight.
LEAST_SHARE = 1 / 400
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…“”„‘’«»"
_CACHE = 200_000
#: Weight of shares of shapes against the presence of single words.
SHAPE_SCALE = 8.0


def _shape(word: str) -> str:
    """Word with runs of capitals, small letters and digits as one sign each; other characters stay, once."""
    out = []
    for c in word:
        s = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


class _Features(dict):
    """Buckets of a raw word: word bucket x SHAPE_BUCKETS + shape bucket."""

    def __missing__(self, word: str) -> int:
        plain = word.lower().strip(_MARKS) or word
        got = xxhash.xxh64_intdigest(plain, 1) % WORD_BUCKETS * SHAPE_BUCKETS
        got += xxhash.xxh64_intdigest(_shape(word), 2) % (SHAPE_BUCKETS - 2)
        if len(word) <= 64:
            if len(self) >= _CACHE:
                self.clear()
            self[word] = got
        return got


def _features() -> _Features:
    return kept(__name__, _Features)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values: 1 for every word that occurs, the share of words for every shape and for repeats.

    Shapes follow the words; the last two positions are repeats of the word before, and the length.
    """
    words = text.split()
    known = _features()
    got = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    if not len(got):
        return np.array([WORD_BUCKETS + SHAPE_BUCKETS - 1]), np.ones(1)
    word, shape = np.divmod(got, SHAPE_BUCKETS)
    repeats = float((word[1:] == word[:-1]).mean()) if len(word) > 1 else 0.0
    present = np.unique(word)
    shapes, n = np.unique(shape, return_counts=True)
    at = np.concatenate((present, WORD_BUCKETS + shapes, [WORD_BUCKETS + SHAPE_BUCKETS - 2]))
    value = np.concatenate((np.ones(len(present)), SHAPE_SCALE * n / len(got), [SHAPE_SCALE * repeats]))
    return at, value


@dataclass
class OrdinalModel:
    """``rows``: number of rated rows it was fitted on; a model of none has no opinion and keeps everything."""

    weights: np.ndarray
    thresholds: np.ndarray
    rows: int = 1

    def sums(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.array([float(self.weights[at] @ value) for at, value in parts])

    def tails(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k but the last, one row per sum."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -40, 40)))

    def keeps(self, tails: np.ndarray, min_tail: float) -> np.ndarray:
        return tails[:, -1] >= min_tail if self.rows else np.ones(len(tails), bool)


def objective(free: np.ndarray, w: np.ndarray, at: np.ndarray, value: np.ndarray, row: np.ndarray, grade: np.ndarray, penalty: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood with the ridge penalty, and its gradient in ``w`` and in ``free``.

    Thresholds stay ordered: the first is free[0], each gap is the exponential of a further free number.
    """
    n, cuts = len(grade), len(free)
    theta = _thresholds(free)
    sums = np.bincount(row, weights=w[at] * value, minlength=n)
    below = 1 / (1 + np.exp(np.clip(sums[:, None] - theta[None, :], -40, 40)))
    cdf = np.concatenate((np.zeros((n, 1)), below, np.ones((n, 1))), axis=1)
    slope = cdf * (1 - cdf)
    rows = np.arange(n)
    p = np.maximum(cdf[rows, grade + 1] - cdf[rows, grade], 1e-9)
    up, low = slope[rows, grade + 1] / p, slope[rows, grade] / p
    pull = penalty / math.sqrt(n) / 10
    g_w = np.bincount(at, weights=(up - low)[row] * value, minlength=len(w)) / n + pull * w
    g_theta = np.array([(low[grade == k + 1].sum() - up[grade == k].sum()) / n for k in range(cuts)])
    g_free = np.concatenate(([g_theta.sum()], np.exp(free[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]))
    return float(-np.log(p).mean() + pull * (w @ w) / 2), g_w, g_free


def _thresholds(free: np.ndarray) -> np.ndarray:
    return np.concatenate(([free[0]], free[0] + np.cumsum(np.exp(free[1:]))))


def fit(at: np.ndarray, value: np.ndarray, row: np.ndarray, grade: np.ndarray, grades: int, rounds: int = ROUNDS, rate: float = RATE, penalty: float = PENALTY) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty on the weights, all rows in every round of adaptive steps.

    With no rows all weights are 0 and every grade is as likely.
    """
    cuts = grades - 1
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / max(len(grade), 1), 0.02, 0.98)
    first = np.log(share / (1 - share)) if len(grade) else np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
    free = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 0.05))))
    held = np.bincount(at, minlength=WORD_BUCKETS + SHAPE_BUCKETS)[at] >= max(2, LEAST_SHARE * len(grade))
    at, value, row = at[held], value[held], row[held]
    used, at = np.unique(at, return_inverse=True)
    w = np.zeros(len(used))
    state = [np.zeros(len(w)), np.zeros(len(w)), np.zeros(cuts), np.zeros(cuts)]
    for t in range(1, rounds + 1 if len(grade) else 1):
        _, g_w, g_free = objective(free, w, at, value, row, grade, penalty)
        for x, g, m, v in ((w, g_w, state[0], state[1]), (free, g_free, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    whole = np.zeros(WORD_BUCKETS + SHAPE_BUCKETS)
    whole[used] = w
    return OrdinalModel(whole, _thresholds(free), len(grade))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 for low quality, 1 for good but toxic, 2 for good. The worst of several labels counts."""
    rows = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return rows.select("doc_id", F.when(F.col("q") < 1, 0).when(F.col("t") > 0, 1).otherwise(2).alias("grade"))


GRADES = 3


def fit_documents(docs: DataFrame, ratings: DataFrame, grades: int = GRADES, rows: int = FIT_ROWS) -> OrdinalModel:
    """Model fitted on at most ``rows`` rated documents; their ids, so many at most, are broadcast."""
    chosen = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.coalesce("text", F.lit("")).alias("text")
    rated = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("grade").cast("int").alias("grade"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            parts = [features(t) for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array([a.astype(np.int32) for a, _ in parts], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in parts], pa.list_(pa.float32()))],
                names=["doc_id", "grade", "at", "value"],
            )

    got = rated.mapInArrow(tidy(run, __name__), "doc_id long, grade int, at array<int>, value array<float>").toArrow()
    # rows that repeat an id are all used; the order does not depend on the tasks
    got = got.sort_by("doc_id")
    grade = got.column("grade").to_numpy()
    lists = got.column("at").combine_chunks()
    n = lists.value_lengths().to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, np.int64)
    at = lists.flatten().to_numpy()
    value = got.column("value").combine_chunks().flatten().to_numpy().astype(np.float64)
    return fit(at, value, np.repeat(np.arange(len(grade)), n), grade.astype(np.int64), grades)


SCORES = "expected_grade double, p_tail double, grade int, kept boolean"


def score(docs: DataFrame, model: OrdinalModel, columns: list[str], text_column: str = "text", min_tail: float = MIN_TAIL) -> DataFrame:
    """``columns`` of ``docs`` with expected_grade, p_tail (of the highest grade), the likeliest grade, and kept."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.rows))
    (own_text,) = unused(columns, "text")
    rows = docs.select(*columns, F.coalesce(F.col(text_column), F.lit("")).alias(own_text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*shared.value)
        for piece in text_pieces(batches, own_text):
            parts = [features(t) for t in piece.column(piece.num_columns - 1).to_pylist()]
            tails = own.tails(own.sums(parts))
            each = -np.diff(np.concatenate((np.ones((len(parts), 1)), tails, np.zeros((len(parts), 1))), axis=1), axis=1)
            added = [tails.sum(axis=1), tails[:, -1], each.argmax(axis=1).astype(np.int32), own.keeps(tails, min_tail)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], *map(pa.array, added)], names=[*columns, "expected_grade", "p_tail", "grade", "kept"]
            )

    return rows.mapInArrow(tidy(run, __name__), f"{schema}, {SCORES}")


def keep_good(docs: DataFrame, model: OrdinalModel, text_column: str = "text", min_tail: float = MIN_TAIL) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that reach ``min_tail`` of the highest grade.

    Null and empty texts have the length mark alone and get what it gives. Repeated rows are judged alike; no rows give
    none. A model fitted on no rows keeps all.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.rows))
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*shared.value)
        for piece in text_pieces(batches, text_column):
            sums = own.sums([features(t or "") for t in piece.column(at).to_pylist()])
            yield piece.filter(pa.array(own.keeps(own.tails(sums), min_tail)))

    return docs.mapInArrow(tidy(run, __name__), docs.schema)


def rate_documents(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, expected_grade, p_tail, grade, kept of every document; labelled or not makes no difference.

    Null and empty texts have the length mark alone and get what it gives. Equal texts get equal results. With no
    usable label every grade is as likely and all documents are kept.
    """
    return score(docs, fit_documents(docs, graded(labels), rows=rows), ["doc_id"])


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
