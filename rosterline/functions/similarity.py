"""Similarity of two texts on a scale of 0 to 100, as plain functions and over columns."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher, get_close_matches

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rosterline.functions.normalize import compact_key, fold_key, fuzzy_key, label_key, loose_key


def block_ratio(left: str, right: str) -> float:
    """Share of both texts in matching blocks, longest first; order of the arguments matters."""
    return SequenceMatcher(None, left, right, autojunk=False).ratio() * 100.0


def ratio(left: str, right: str) -> float:
    """0 if either is empty, 100 if equal, else ``block_ratio``."""
    if not left or not right:
        return 0.0
    return 100.0 if left == right else block_ratio(left, right)


def token_sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def sorted_ratio(left: str, right: str) -> float:
    """The better of the texts as they are and with their words sorted."""
    if not left or not right or left == right:
        return ratio(left, right)
    return max(block_ratio(left, right), block_ratio(token_sorted(left), token_sorted(right)))


def key_ratio(left: object, right: object) -> float:
    """Ratio of fuzzy keys."""
    return ratio(fuzzy_key(left), fuzzy_key(right))


def label_forms(label: str, kind: str = "student") -> tuple[str, str, str]:
    """A strict key as it is, its loose form, and that with its words sorted."""
    loose = loose_key(label) if kind == "student" else label_key(kind, label)
    return label, loose, token_sorted(loose)


def label_ratio(left: str, right: str, kind: str = "student") -> float:
    """Best ratio over the forms of two strict keys."""
    return max(map(ratio, label_forms(left, kind), label_forms(right, kind))) if left and right else 0.0


def cluster_ratio(left: set[str], right: set[str], kind: str) -> float:
    """Complete linkage: the least similar pair across."""
    return min(label_ratio(a, b, kind) for a in left for b in right)


def snapped(value: object, vocabulary: list[str], cutoff: float = 0.68) -> str:
    """Closest word of a vocabulary to a misread one: equal, then close as folded text, then without spaces."""
    for key in (fold_key, compact_key):
        known = {key(v): v for v in reversed(vocabulary)}
        text = key(value)
        if not text:
            return ""
        if text in known:
            return known[text]
        close = get_close_matches(text, list(known), n=1, cutoff=cutoff)
        if close:
            return known[close[0]]
    return ""


KERNELS: dict[str, Callable[[str, str], float]] = {"ratio": ratio, "sorted": sorted_ratio, "key": key_ratio, "label": label_ratio}


def similarity(left: Column | str, right: Column | str, kind: str = "ratio") -> Column:
    """Similarity of two columns in Arrow batches; a pair that repeats in a batch is worked out once, null gives null."""
    rule = KERNELS[kind]

    @F.pandas_udf(DoubleType())
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple, float | None] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair not in known:
                known[pair] = None if pair[0] is None or pair[1] is None else rule(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return apply(left, right)


def scored_pairs(pairs: DataFrame, left: str, right: str, name: str = "score", kind: str = "ratio") -> DataFrame:
    """``pairs`` with the similarity of two columns; what is equal or empty is settled without Python.

    Pairs are scored where they are. Scoring distinct pairs and joining them back would shuffle all
    pairs twice to save comparisons that mostly repeat inside a batch anyway.
    """
    a, b = F.col(left), F.col(right)
    empty = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    hard = ~empty & (a != b)
    rows = pairs.withColumn("__s", similarity(F.when(hard, a), F.when(hard, b), kind))
    return rows.withColumn(name, F.when(empty, 0.0).when(a == b, 100.0).otherwise(F.col("__s"))).drop("__s")


def _scored(rule: Callable[[str, str], float]):
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([rule(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(apply, DoubleType())


def register(spark: SparkSession) -> None:
    """The kernels as SQL functions similarity_<kind>."""
    for kind, rule in KERNELS.items():
        spark.udf.register(f"similarity_{kind}", _scored(rule))
