"""The near-copies stage against brute-force similarity of word shingles."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from rosterline.llm import nearcopies


def kept_by_brute_force(given):
    def own(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 5, 0) + 1)} if w else set()

    sets, root = [own(t) for _, t in given], list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(given)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if (len(x & y) / len(x | y) if x or y else 1.0) >= 0.8:
                i, j = find(a), find(b)
                root[max(i, j)] = min(i, j)
    return sorted(given[i][0] for i in range(len(given)) if find(i) == i)


def corpus():
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    texts = [None, "", " \t", "one two", "ONE  two", "one two three four five six"]
    for edits in (1, 2, 3, 4, 5, 6, 8):
        for _ in range(4):
            base = [word() for _ in range(200)]
            near = list(base)
            for at in rng.sample(range(10, 190), edits):
                near[at] = word()
            texts += [" ".join(base), " ".join(near)]
    hub = [word() for _ in range(150)]
    for _ in range(40):
        near = list(hub)
        near[rng.randrange(150)] = word()
        texts.append(" ".join(near))
    return list(enumerate(texts))


@pytest.mark.parametrize("limits", [{}, {"small": 2, "rounds": 1, "cap": 3}])
def test_stage_equals_brute_force_similarity(spark, limits):
    given = corpus()
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    stage = nearcopies.keep_dissimilar(docs, **limits) if limits else corpus_pipeline.near_duplicates(spark, docs, "")
    want = kept_by_brute_force(given)
    assert sorted(r["doc_id"] for r in stage.collect()) == want and 30 < len(want) < 60
    assert nearcopies.keep_dissimilar(docs.limit(0)).count() == 0
