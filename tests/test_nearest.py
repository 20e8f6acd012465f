"""Bounds, blocks and sparse greedy matching against plain versions."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from rosterline.functions import evidence
from rosterline.functions.similarity import label_ratio, ratio, sorted_ratio
from rosterline.operators import linkage, nearest, tracking

NAMES = st.lists(st.text("abcdeğİı ", max_size=80), min_size=1, max_size=8)


def longest_common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


@given(st.text("abcdeğİı ", max_size=100), NAMES)
def test_bounds_are_never_too_low(text, names):
    texts = nearest.Texts(names)
    common = texts.common(text)
    for k, name in enumerate(names):
        want = longest_common(text, name)
        assert common[k] == want if len(text) <= 64 else common[k] >= want
    bound = texts.bounds(text)
    assert all(bound[k] >= ratio(text, n) for k, n in enumerate(names))


@given(st.text("abc ", max_size=20), NAMES)
def test_best_is_the_best(text, names):
    for kind, rule in (("ratio", ratio), ("sorted", sorted_ratio), ("label", label_ratio)):
        if kind == "sorted" and not (text.strip() and all(n.strip() for n in names)):
            continue
        held = nearest.Side(names, kind).against(text)
        want = sorted(((rule(text, n), -k) for k, n in enumerate(names)), reverse=True)[:2]
        assert [(held.score(k), -k) for k in held.best(2, lambda k: (-k,))] == want
        assert sorted(held.reaching(60.0)) == [(k, rule(text, n)) for k, n in enumerate(names) if rule(text, n) >= 60]


@given(st.text("abcdeğİı ", max_size=150), NAMES)
def test_letter_bounds_are_never_too_low(text, names):
    texts = nearest.Texts(names)
    assert (texts.quick_bounds(text) >= texts.bounds(text)).all()
    assert (texts.quick_bounds(text, np.arange(len(names))) == texts.quick_bounds(text)).all()


def test_letters_rule_most_pairs_out(monkeypatch):
    rng = random.Random(5)
    names = [" ".join("".join(rng.choice("bcdfghjkaeioulmn") for _ in range(6)) for _ in range(4)) for _ in range(2000)]
    looked, common = [], nearest.Texts.common
    monkeypatch.setattr(nearest.Texts, "common", lambda self, text, which=None: looked.append(self.places.shape[1] if which is None else len(which)) or common(self, text, which))
    side = nearest.Side(names)
    for k in range(0, 200, 10):
        for text in (names[k], names[k][:20], names[k][:13], names[k][7:] + " " + names[k][:6]):
            held = side.against(text)
            assert [j for j, _ in held.reaching(90.0)] == ([k] if text == names[k] else [])
            assert held.best(1, lambda j: (-j,)) == [k]
    assert sum(looked) < 0.1 * 80 * len(names)


def test_best_from_a_known_score_on_looks_at_less(monkeypatch):
    rng = random.Random(6)
    names = [" ".join("".join(rng.choice("bcdfghjkaeioulmn") for _ in range(6)) for _ in range(4)) for _ in range(1000)]
    side, looked, common = nearest.Side(names[1:], "sorted"), [], nearest.Texts.common
    held = side.against(names[0])
    best = held.best(1, lambda j: (-j,))
    assert held.best(1, lambda j: (-j,), least=held.score(best[0])) == best
    monkeypatch.setattr(nearest.Texts, "common", lambda self, text, which=None: looked.append(1) or common(self, text, which))
    assert side.against(names[0]).best(1, lambda j: (-j,), least=95.0) == [] and not looked


def test_advice_starts_from_shared_words(spark):
    rows = spark.createDataFrame([(1, "k", "ab cd"), (2, "k", "zz"), (3, "k", ""), (4, "l", "ab")], "src_row long, section string, student string")
    people = spark.createDataFrame([("k", "ab ce"), ("k", "xx cd ab"), ("l", "ac")], "section string, r_student string")
    got = {r["src_row"]: r["least"] for r in linkage._word_scores(rows, people, ["section"]).collect()}
    assert got == {1: max(sorted_ratio("ab cd", n) for n in ("ab ce", "xx cd ab"))}


def test_all_evidence_is_among_the_tellers():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.choice((1, 1, 2, 3, 6))))
    names = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(300)]
    tellers = nearest.Tellers(names, evidence.FLOOR)
    found = 0
    for name in names[:150]:
        may = set(tellers.of(name).tolist())
        told = {k for k, other in enumerate(names) if evidence.name_evidence(name, other).pattern}
        assert told <= may
        found += len(told)
    assert found > 50


def test_blocks_meet_every_pair_once(spark):
    left = spark.createDataFrame([(k % 3, k) for k in range(100)], "g long, a long")
    right = spark.createDataFrame([(k % 4, k) for k in range(90)], "g long, b long")

    def pairs(x, y):
        import pandas as pd

        return pd.DataFrame([(i, j) for i in x["a"] for j in y["b"]], columns=["a", "b"])

    got = [tuple(r) for r in nearest.in_blocks(left, right, ["g"], "a", "b", pairs, "a long, b long", rows=7).collect()]
    assert sorted(got) == [(i, j) for i in range(100) for j in range(90) if i % 3 == j % 4]
    assert nearest.in_blocks(left.limit(0), right, ["g"], "a", "b", pairs, "a long, b long").count() == 0


def plain_clusters(first, kind, threshold, margin):
    """Everything ranked anew after every merge."""
    forms = {}
    for label in first:
        forms.setdefault(tracking.label_key(kind, label), []).append(label)
    groups = [sorted(v) for v in forms.values()]
    while len(groups) > 1:
        s = {(i, j): min(label_ratio(x, y, kind) for x in groups[min(i, j)] for y in groups[max(i, j)]) for i in range(len(groups)) for j in range(len(groups)) if i != j}
        top = {}
        for i in range(len(groups)):
            ranked = sorted((-s[i, j], j) for j in range(len(groups)) if j != i)
            top[i] = (-ranked[0][0], ranked[0][1], -ranked[1][0] if len(ranked) > 1 else 0.0)
        fits = [(v, -i, -j) for i, (v, j, second) in top.items() if i < j and top[j][1] == i and v >= threshold and v - second >= margin and v - top[j][2] >= margin]
        if not fits:
            break
        _, i, j = max(fits)
        i, j = -i, -j
        groups = [g for k, g in enumerate(groups) if k not in (i, j)] + [groups[i] + groups[j]]
    return sorted((sorted(g) for g in groups), key=lambda g: min(first[x] for x in g))


def test_clusters_equal_ranking_anew():
    rng = random.Random(8)
    for _ in range(40):
        base = ["".join(rng.choice("ABCD") for _ in range(9)) for _ in range(4)]
        labels = {b[:k] + rng.choice("ABXY") + b[k + 1 :] for b in base for k in (2, 5)} | set(base)
        first = {x: (1, k) for k, x in enumerate(sorted(labels, key=lambda _: rng.random()))}
        got = [sorted(g) for g in tracking.cluster_labels(first, "school", 85, 3)]
        assert got == plain_clusters(first, "school", 85, 3)


def test_labels_are_clustered_alike_in_blocks(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("ABCDEFGH") for _ in range(12)) for _ in range(12)]
    rows = [(1, 10 * k + n, g, label) for g in ("x", "y") for k, b in enumerate(base) for n, label in enumerate((b, b[:5] + "Z" + b[6:], b + "Q"))]
    df = spark.createDataFrame(rows, "period int, row_number long, d string, school string")
    got = {(r["d"], r["label"]): (r["cluster_id"], r["canonical"]) for r in tracking.label_clusters(df, "school", "school", within=["d"]).collect()}
    for g in ("x", "y"):
        first = {label: (1, n) for p, n, d, label in rows if d == g}
        want = plain_clusters(first, "school", 90, 5)
        assert {x: got[g, x][0] for x in first} == {x: k for k, group in enumerate(want, 1) for x in group}
    whole = tracking.label_clusters(df.where("d = 'x'"), "school", "school").collect()
    assert {r["label"]: r["cluster_id"] for r in whole} == {x: got["x", x][0] for x in {r[3] for r in rows if r[2] == "x"}}


def test_advice_and_resolution_do_not_depend_on_blocks(spark):
    from rosterline.plans.fixtures import derived

    sf = "/root/testdata/sf0.001"
    src, roster = derived(spark, sf, "src"), derived(spark, sf, "roster")
    people = [r.asDict() for r in roster.collect()]
    classified = linkage.legacy_classify(src, roster)
    status = {r["src_row"]: r for r in classified.collect()}
    got = {r["src_row"]: (r["best_row"], r["best_score"]) for r in linkage.legacy_advice(src, roster, classified).collect()}
    sections = {p["section"] for p in people}
    want = {}
    for s in src.collect():
        if status[s["src_row"]]["status"] != "unmatched":
            continue
        at = (status[s["src_row"]]["r_district"], status[s["src_row"]]["r_school"], s["section"])
        if at[0] is not None:
            pool = [p for p in people if (p["district"], p["school"], p["section"]) == at]
        else:
            pool = [p for p in people if p["section"] == s["section"]] if s["section"] in sections else people
        place = lambda p: 0.35 * sorted_ratio(s["district"], p["district"]) + 0.65 * sorted_ratio(s["school"], p["school"])  # noqa: B023, E731
        score, _, row = max((sorted_ratio(s["student"], p["student"]), place(p), -p["row_number"]) for p in pool)
        want[s["src_row"]] = (-row, score)
    assert got == want and len(want) > 20
