"""Following students over three periods: label clusters, one-to-one matches, section reconciliation."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from itertools import combinations
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.functions.normalize import label_key, loose_key, normalised
from rosterline.functions.similarity import label_ratio
from rosterline.operators.nearest import Side, best_rows, possible_pairs, similar_pairs
from rosterline.operators.relational import numbered
from rosterline.operators.scratch import written

LABELS = {1: "1st Semester 3rd Grade", 2: "2nd Semester 3rd Grade", 3: "4th Grade"}
EXPECTED_GRADES = {1: 3, 2: 3, 3: 4}


#: What a row of a period sheet can lack, in the order it is looked for, with the reason that is given; only the last one keeps its row.
FAULTS = {
    "Incomplete location data": "District, school, and section are required for strict district-school-section matching.",
    "Unexpected grade": "The row was excluded because its grade did not match the period.",
    "Invalid section": "The section must contain exactly one letter.",
    "Blank student name": "The section is treated as present, but this row is not counted as a student.",
}


def period_faults(rows: DataFrame, expected: dict[int, int] | None = None) -> DataFrame:
    """``rows`` (period, district, school, grade, section, student as text) with ``section_key``, ``issue_type`` and ``kept``; wholly blank rows go.

    A row has its first fault at most. A blank student name keeps the row: the section is there, the student is not.
    """
    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    expected = expected or EXPECTED_GRADES
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])[F.col("period")]
    number = F.regexp_replace(F.trim("grade"), ",", ".").try_cast("double")
    same = F.coalesce(number == wanted, F.lit(False))
    letter = F.upper(F.translate(F.trim(F.coalesce("section", F.lit(""))), "ıi", "Iİ"))
    key = F.when(letter.rlike("^[A-ZÇĞİÖŞÜ]$"), letter).otherwise("")
    place = empty("district") | empty("school") | empty("section")
    checks = dict(zip(FAULTS, (place, ~same, key == "", empty("student")), strict=True))
    issue = F.lit("")
    for name in reversed(FAULTS):
        issue = F.when(checks[name], name).otherwise(issue)
    rows = rows.where(~reduce(and_, map(empty, ("district", "school", "grade", "section", "student"))))
    return rows.withColumns({"section_key": key, "issue_type": issue}).withColumn("kept", F.col("issue_type").isin("", "Blank student name"))


def data_issues(faulty: DataFrame) -> DataFrame:
    """Review rows of the faults that ``period_faults`` found."""
    labels = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    why = F.create_map(*[F.lit(x) for pair in FAULTS.items() for x in pair])
    kind = F.col("issue_type")
    place = F.concat(F.lit("District="), F.col("district"), F.lit("; School="), F.col("school"), F.lit("; Section="), F.col("section"))
    original = F.when(kind == "Incomplete location data", place).when(kind == "Unexpected grade", F.col("grade")).when(kind == "Invalid section", F.col("section")).otherwise("")
    grade = F.create_map(*[F.lit(x) for pair in EXPECTED_GRADES.items() for x in pair])[F.col("period")].cast("string")
    return faulty.where(kind != "").select(
        F.lit("Data issue").alias("status"), kind.alias("issue_type"), "district", "school", F.when(kind == "Blank student name", F.col("section_key")).otherwise(F.col("section")).alias("section"),
        labels[F.col("period")].alias("period"), F.col("row_number").cast("string").alias("source_row"), original.alias("original_value"),
        F.when(kind == "Unexpected grade", grade).otherwise("").alias("candidate_value"), F.lit(None).cast("double").alias("similarity_score"),
        F.lit(None).cast("double").alias("second_best_score"), why[kind].alias("reason"),
    )


class Mutual:
    """Mutually best pairs of a sparse graph, taken one by one with all else ranked anew, without ranking all else anew.

    Only nodes beside a pair that was taken change, so only these are looked at again; what may be taken waits in a heap
    and is checked once more when it comes up. A node ranks its neighbours by score, then by the least name. Links that
    are not there count as 0 and must be too low to matter: under the threshold by more than the margin.
    """

    def __init__(self, links: dict, threshold: float, margin: float, urgency: Callable):
        self.links, self.threshold, self.margin, self.urgency = links, threshold, margin, urgency
        self.heap: list[tuple] = []
        for node in links:
            self.offer(node)

    def top(self, node: object) -> tuple[float, object, float]:
        """Best score, the neighbour that has it, and the next best score."""
        two = heapq.nsmallest(2, ((-s, other) for other, s in self.links[node].items()))
        return (-two[0][0], two[0][1], -two[1][0] if len(two) > 1 else 0.0) if two else (0.0, None, 0.0)

    def fits(self, node: object) -> tuple | None:
        """(score, node, its best) if the two are mutually best, good enough and clear of all others."""
        score, other, second = self.top(node)
        if other is None or score < self.threshold or score - second < self.margin:
            return None
        back, home, next_back = self.top(other)
        return (score, node, other) if home == node and back - next_back >= self.margin else None

    def offer(self, node: object) -> None:
        found = self.fits(node)
        if found:
            score, *pair = found
            a, b = sorted(pair)
            heapq.heappush(self.heap, (-score, self.urgency(a, b), a, b))

    def take(self) -> tuple[float, object, object] | None:
        """The next pair, which leaves the graph; None when no pair is left."""
        while self.heap:
            _, _, a, b = heapq.heappop(self.heap)
            if a in self.links and b in self.links and (found := self.fits(a)) and found[2] == b:
                near = (set(self.links[a]) | set(self.links[b])) - {a, b}
                self.gone = {x: self.links.pop(x) for x in (a, b)}
                for x in near:
                    self.links[x].pop(a, None)
                    self.links[x].pop(b, None)
                self.near = near
                return found[0], a, b
        return None

    def settle(self, nodes: set) -> None:
        for x in nodes:
            self.offer(x)


def cluster_labels(first_seen: dict[str, tuple[int, int]], kind: str, threshold: float, margin: float, pairs: Iterable[tuple[str, str]] | None = None, score: Callable[[str, str], float] | None = None) -> list[list[str]]:
    """Clusters of labels: equal loose forms, then the best mutual pair merged again and again.

    A pair needs ``threshold``, and ``margin`` over each side's next best (0 if there is none); similarity is the least
    over the pairs across, compared in the order of the clusters. Of several the highest, then the earliest pair merges,
    and the merged cluster goes last. ``pairs`` are those of labels that can score at all near the threshold; all where none are given.
    """
    score = score or (lambda a, b: label_ratio(a, b, kind))
    forms: dict[str, list[str]] = {}
    for label in first_seen:
        forms.setdefault(label_key(kind, label), []).append(label)
    groups = dict(enumerate(sorted(v) for v in forms.values()))
    of = {label: k for k, group in groups.items() for label in group}
    near: dict[int, set[int]] = {k: set() for k in groups}
    for a, b in combinations(first_seen, 2) if pairs is None else pairs:
        if of[a] != of[b]:
            near[of[a]].add(of[b])
            near[of[b]].add(of[a])

    def least(i: int, j: int) -> float:
        return min(score(x, y) for x in groups[min(i, j)] for y in groups[max(i, j)])

    links: dict[int, dict[int, float]] = {k: {} for k in groups}
    for i, others in near.items():
        for j in others:
            if i < j:
                links[i][j] = links[j][i] = least(i, j)
    graph = Mutual(links, threshold, margin, urgency=lambda a, b: (a, b))
    fresh = len(groups)
    while pair := graph.take():
        _, a, b = pair
        groups[fresh] = groups.pop(a) + groups.pop(b)
        both = set(graph.gone[a]) & set(graph.gone[b])
        links[fresh] = {}
        for k in both:
            links[fresh][k] = links[k][fresh] = least(k, fresh)
        graph.settle(graph.near | {fresh})
        fresh += 1
    return sorted(groups.values(), key=lambda g: min(first_seen[x] for x in g))


CLUSTERS = "label string, cluster_id long, canonical string"


def label_clusters(rows: DataFrame, label: str, kind: str, period: str = "period", row: str = "row_number", within: list[str] | None = None, threshold: float = 90.0, margin: float = 5.0) -> DataFrame:
    """Cluster and canonical label (the earliest seen) of each distinct label, per value of ``within`` if given.

    Pairs of labels that can come near the threshold are found in blocks of bounded size; the task that merges the
    labels of one group holds these pairs and the labels, not all pairs.
    """
    within = within or []
    seen = rows.where(F.coalesce(F.col(label), F.lit("")) != "").groupBy(*within, label).agg(F.min(F.struct(period, row)).alias("seen"))
    seen = seen.select(*within, F.col(label).alias("label"), F.col(f"seen.{period}").cast("long").alias("p"), F.col(f"seen.{row}").cast("long").alias("r"))
    pairs = possible_pairs(seen, within, "label", threshold - 10.0 - margin, "district" if kind == "district" else "label")

    def work(part: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        first = {x: (int(p), int(r)) for x, p, r in sorted(zip(part["label"], part["p"], part["r"], strict=True), key=lambda t: t[1:])}
        out = []
        for number, group in enumerate(cluster_labels(first, kind, threshold, margin, list(zip(near["a"], near["b"], strict=True))), 1):
            canonical = min(group, key=lambda x: first[x])
            out += [(x, number, canonical) for x in group]
        got = pd.DataFrame(out, columns=["label", "cluster_id", "canonical"])
        for k, name in enumerate(within):
            got.insert(k, name, part[name].iloc[0] if len(part) else None)
        return got

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in seen.select(*within).schema] if within else []
    one, two = (df.groupBy(*(within or [F.lit(1).alias("one")])) for df in (seen, pairs))
    return one.cogroup(two).applyInPandas(work, ", ".join([*fields, CLUSTERS]))


def institutions(rows: DataFrame, district: tuple[float, float] = (90.0, 5.0), school: tuple[float, float] = (88.0, 5.0)) -> DataFrame:
    """(district, school, district_id, school_id, district_name, school_name) of every distinct pair of strict keys.

    Districts are clustered first, schools inside each district. Numbers of districts follow the first row of each; those
    of schools run on across the districts, which are gone through by the loose form of their name.
    """
    d = label_clusters(rows, "district", "district", threshold=district[0], margin=district[1])
    d = d.select(F.col("label").alias("district"), F.format_string("D%05d", "cluster_id").alias("district_id"), F.col("canonical").alias("district_name"))
    placed = rows.join(d, "district")
    s = label_clusters(placed, "school", "school", within=["district_id", "district_name"], threshold=school[0], margin=school[1])
    s = s.withColumn("loose", normalised("district_name", "loose"))
    first = numbered(s.select("loose", "district_id", "cluster_id").distinct(), ["loose", "district_id"], ["cluster_id"], "number")
    s = s.join(first.select("district_id", "cluster_id", "number"), ["district_id", "cluster_id"])
    s = s.select("district_id", F.col("label").alias("school"), F.format_string("S%05d", "number").alias("school_id"), F.col("canonical").alias("school_name"))
    return placed.select("district", "school", "district_id", "district_name").distinct().join(s, ["district_id", "school"])


def match_one_to_one(left: Sequence[tuple], right: Sequence[tuple], threshold: float = 90.0, margin: float = 5.0) -> list[tuple]:
    """(left row, right row, score, method) of two lists of (row, strict name).

    Equal names pair in row order. Of the rest, the one best pair that is mutual and clear of the next best on both sides
    is taken, then all is ranked anew; ties go to the larger rows.
    """
    matches, by_name = [], {}
    for row, name in sorted(right):
        by_name.setdefault(name, []).append(row)
    rest = []
    for row, name in sorted(left):
        if by_name.get(name):
            matches.append((row, by_name[name].pop(0), 100.0, "Exact"))
        else:
            rest.append((row, name))
    others = [(row, name) for name, rows in by_name.items() for row in rows]
    side = Side([name for _, name in others], "label")
    scored = [(x, n, *others[k], s) for x, n in rest for k, s in side.against(n).reaching(threshold - margin)]
    return matches + greedy_matches(scored, threshold, margin)


def greedy_matches(scored: Iterable[tuple], threshold: float, margin: float) -> list[tuple]:
    """Matches among (left row, left name, right row, right name, score) of all pairs within ``margin`` of the threshold."""
    links: dict[tuple, dict[tuple, float]] = {}
    names = {}
    for x, n, y, m, s in scored:
        links.setdefault((0, x), {})[1, y] = s
        links.setdefault((1, y), {})[0, x] = s
        names[0, x], names[1, y] = n, m
    graph = Mutual(links, threshold, margin, urgency=lambda a, b: (-a[1], -b[1]))
    out = []
    while pair := graph.take():
        score, a, b = pair
        out.append((a[1], b[1], score, "Normalized" if loose_key(names[a]) == loose_key(names[b]) else "Fuzzy"))
        graph.settle(graph.near)
    return out


MATCHES = "left_row long, right_row long, score double, method string"


def match_periods(left: DataFrame, right: DataFrame, keys: list[str], threshold: float = 90.0, margin: float = 5.0) -> DataFrame:
    """One-to-one matches of two periods inside each group of ``keys``.

    Exact names are matched by a join. Of the rest, pairs within ``margin`` of the threshold are found in blocks of
    bounded size, and a task that matches one group holds only these.
    """
    def numbered_rows(df: DataFrame, side: str) -> DataFrame:
        place = Window.partitionBy(*keys, "student").orderBy("row_number")
        return df.select(*keys, "student", F.col("row_number").alias(f"{side}_row"), F.row_number().over(place).alias("k"))

    one, two = numbered_rows(left, "left"), numbered_rows(right, "right")
    exact = one.join(two, [*keys, "student", "k"])
    rest_one = one.join(exact.select(*keys, "left_row"), [*keys, "left_row"], "left_anti").select(*keys, F.col("student").alias("left_student"), "left_row")
    rest_two = two.join(exact.select(*keys, "right_row"), [*keys, "right_row"], "left_anti").select(*keys, F.col("student").alias("right_student"), "right_row")
    pairs = similar_pairs(rest_one, rest_two, keys, "left_row", "left_student", "right_row", "right_student", threshold - margin, "label")
    pairs = pairs.join(rest_one, [*keys, "left_row"]).join(rest_two, [*keys, "right_row"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.select(*keys).schema)

    def work(part: pd.DataFrame) -> pd.DataFrame:
        columns = [part[c] for c in ("left_row", "left_student", "right_row", "right_student", "score")]
        out = pd.DataFrame(greedy_matches(zip(*columns, strict=True), threshold, margin), columns=["left_row", "right_row", "score", "method"])
        for k, name in enumerate(keys):
            out.insert(k, name, part[name].iloc[0])
        return out

    fuzzy = pairs.groupBy(*keys).applyInPandas(work, f"{fields}, {MATCHES}")
    sure = exact.select(*keys, "left_row", "right_row", F.lit(100.0).alias("score"), F.lit("Exact").alias("method"))
    return sure.unionByName(fuzzy)


def unmatched(left: DataFrame, right: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, row, student, other, score, second, other_second) of what ``matches`` leaves on both sides of two periods.

    ``other`` is the best row left on the other side, the first of equals, null where none is left; ``second`` is the
    next best score of the row itself, ``other_second`` that of its candidate. What is read several times is written, so
    that no plan holds what came before it more than once.
    """
    rest = {
        side: written(df.join(matches.select(*keys, F.col(f"{side}_row").alias("row_number")), [*keys, "row_number"], "left_anti").select(*keys, F.col("row_number").alias("row"), F.col("student").alias("text")))
        for side, df in (("left", left), ("right", right))
    }
    best = {
        "left": written(best_rows(rest["left"], rest["right"], keys, "label")),  # each is read for its own side and for the other
        "right": written(best_rows(rest["right"], rest["left"], keys, "label", turned=True)),
    }
    got = None
    for side, across in (("left", "right"), ("right", "left")):
        theirs = best[across].select(*keys, F.col("row").alias("other"), F.col("second").alias("other_second"))
        rows = rest[side].withColumnRenamed("text", "student").join(best[side], [*keys, "row"], "left").join(theirs, [*keys, "other"], "left")
        rows = rows.select(*keys, F.lit(side).alias("side"), "row", "student", "other", "score", "second", "other_second")
        got = rows if got is None else got.unionByName(rows)
    return got


def student_issues(matches: DataFrame, rest: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], periods: tuple[int, int], threshold: float = 90.0, margin: float = 5.0) -> DataFrame:
    """Review rows of two periods: matches that are not exact, accepted; and of what is left, best candidates no more than 10 under the threshold."""
    names = [df.select(*keys, F.col("row_number").alias(f"{side}_row"), F.col("student").alias(value)) for df, side, value in ((left, "left", "original_value"), (right, "right", "candidate_value"))]
    sure = matches.where("method <> 'Exact'").select(
        *keys, "left_row", "right_row", F.lit("Auto-accepted").alias("status"), F.concat("method", F.lit(" student match")).alias("issue_type"), "score", F.lit(None).cast("double").alias("second"),
        F.lit(f"Mutually best one-to-one candidates above threshold {threshold:.1f} with margin at least {margin:.1f}.").alias("reason"),
    )
    second = F.greatest("second", "other_second")
    why = (
        F.when(F.col("score") < threshold, f"Best score is below automatic threshold {threshold:.1f}.")
        .when(F.col("score") - second < margin, f"Competing candidates are within margin {margin:.1f}.").otherwise("The candidate relationship is not mutually best.")
    )
    open_rows = rest.where((F.col("side") == "left") & (F.col("score") >= max(0.0, threshold - 10.0))).select(
        *keys, F.col("row").alias("left_row"), F.col("other").alias("right_row"), F.lit("Needs review").alias("status"), F.lit("Ambiguous student match").alias("issue_type"), "score",
        second.alias("second"), F.concat(why, F.lit(" The rows were kept unmatched.")).alias("reason"),
    )
    both = sure.unionByName(open_rows).join(names[0], [*keys, "left_row"]).join(names[1], [*keys, "right_row"])
    rows = F.concat_ws(" / ", F.col("left_row").cast("string"), F.col("right_row").cast("string"))
    return both.select(
        "status", "issue_type", *keys, F.lit(f"{LABELS[periods[0]]} vs {LABELS[periods[1]]}").alias("period"), rows.alias("source_row"), "original_value", "candidate_value",
        F.round("score", 2).alias("similarity_score"), F.round("second", 2).alias("second_best_score"), "reason",
    )


def section_reconciliation(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per section that the first period has: students per period, exact matches, missing and extra ones.

    Students match by name and occurrence. An exact roster has the section and nothing missing or extra.
    """
    place = Window.partitionBy("period", *keys, "student").orderBy("row_number")
    rows = periods.withColumn("k", F.row_number().over(place))
    flags = rows.groupBy(*keys, "student", "k").agg(*[F.max((F.col("period") == p).cast("int")).alias(f"p{p}") for p in (1, 2, 3)])
    has = lambda *on: F.count_if(F.lit(True) if not on else on[0])
    p1, p2, p3 = (F.col(f"p{p}") == 1 for p in (1, 2, 3))
    got = flags.groupBy(*keys).agg(
        has(p1).alias("baseline"), has(p2).alias("second"), has(p3).alias("third"), has(p1 & p2).alias("matched_second"), has(p1 & p3).alias("matched_third"),
        has(p1 & p2 & p3).alias("matched_both"), has(~p1 & p2).alias("extra_second"), has(~p1 & p3).alias("extra_third"),
    ).where("baseline > 0")
    return got.withColumns({
        "missing_second": F.col("baseline") - F.col("matched_second"), "missing_third": F.col("baseline") - F.col("matched_third"),
        "missing_either": F.col("baseline") - F.col("matched_both"),
        "exact_roster_second": (F.col("second") > 0) & (F.col("baseline") == F.col("matched_second")) & (F.col("extra_second") == 0),
        "exact_roster_third": (F.col("third") > 0) & (F.col("baseline") == F.col("matched_third")) & (F.col("extra_third") == 0),
    })


def student_exceptions(periods: DataFrame, keys: list[str]) -> DataFrame:
    """First-period students that later periods lack, by name and occurrence."""
    place = Window.partitionBy("period", *keys, "student").orderBy("row_number")
    rows = periods.withColumn("k", F.row_number().over(place))
    flags = rows.groupBy(*keys, "student", "k").agg(
        F.min(F.when(F.col("period") == 1, F.col("row_number"))).alias("row_number"), *[F.max((F.col("period") == p).cast("int")).alias(f"p{p}") for p in (1, 2, 3)]
    )
    kind = (
        F.when((F.col("p2") == 0) & (F.col("p3") == 0), "Missing from Sheets 2 and 3").when(F.col("p2") == 0, "Missing from Sheet 2")
        .when(F.col("p3") == 0, "Missing from Sheet 3")
    )
    return flags.where("p1 = 1").select(*keys, "student", "row_number", kind.alias("exception_type")).where("exception_type IS NOT NULL")


def _students(periods: DataFrame) -> DataFrame:
    return periods.where(F.trim(F.coalesce("student", F.lit(""))) != "")


def _sections(periods: DataFrame, keys: list[str]) -> DataFrame:
    return periods.groupBy(*keys).agg(*[F.max((F.col("period") == p).cast("int")).alias(f"has_{p}") for p in (1, 2, 3)])


def comparison_plan(periods: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, mode, left_period, right_period): which periods are compared per section, 1 with 2 and 3, or 2 with 3 where 1 lacks it."""
    step = lambda a, b: F.struct(F.lit(a).alias("left_period"), F.lit(b).alias("right_period"))
    based = F.col("has_1") == 1
    plan = F.when(based, F.array(step(1, 2), step(1, 3))).otherwise(F.array(step(2, 3)))
    mode = F.when(based, "Sheet 1 baseline").otherwise("Sheets 2-3 comparison (no Sheet 1 baseline)")
    return _sections(periods, keys).select(*keys, mode.alias("mode"), F.explode(plan).alias("x")).select(*keys, "mode", "x.*")


def _planned(periods: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Students of the left and of the right period of every compared pair, and the keys with the pair among them: all pairs are one job."""
    rows, pair = _students(periods), ["left_period", "right_period"]
    plan = comparison_plan(periods, keys).select(*keys, *pair)
    left, right = (rows.join(plan, keys).where(F.col("period") == F.col(p)).select(*keys, *pair, "row_number", "student") for p in pair)
    return left, right, [*keys, *pair]


def residuals(periods: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """What is left on both sides of all compared pairs of periods, with the best candidates."""
    left, right, placed = _planned(periods, keys)
    return unmatched(left, right, matches, placed)


def residuals_by_pair(periods: DataFrame, matches: DataFrame, keys: list[str]) -> dict[tuple[int, int], DataFrame]:
    """``residuals`` by pair of periods; all come from one result that is kept."""
    rest = residuals(periods, matches, keys).persist()
    return {(a, b): rest.where((F.col("left_period") == a) & (F.col("right_period") == b)).drop("left_period", "right_period") for a, b in ((1, 2), (1, 3), (2, 3))}


def match_review(periods: DataFrame, matches: DataFrame, keys: list[str], rest: dict[tuple[int, int], DataFrame] | None = None, threshold: float = 90.0, margin: float = 5.0) -> DataFrame:
    """Review rows of all compared pairs of periods: accepted matches that are not exact, and candidates left to a person."""
    rows, got = _students(periods), None
    for (one, two), df in (rest or residuals_by_pair(periods, matches, keys)).items():
        found = matches.where((F.col("left_period") == one) & (F.col("right_period") == two))
        more = student_issues(found, df, rows.where(F.col("period") == one), rows.where(F.col("period") == two), keys, (one, two), threshold, margin)
        got = more if got is None else got.unionByName(more)
    return got


def section_matches(periods: DataFrame, keys: list[str], threshold: float = 90.0, margin: float = 5.0) -> DataFrame:
    """One-to-one matches of periods 1 and 2 and 1 and 3, or 2 and 3 in sections that period 1 lacks."""
    left, right, placed = _planned(periods, keys)
    return match_periods(left, right, placed, threshold, margin)


def matched_reconciliation(periods: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per section by the one-to-one ``matches`` of ``section_matches``.

    Sections of the first period count its students in the later ones; the others, with has_baseline
    false, count what periods 2 and 3 share and each has alone. What does not apply is null.
    """
    sizes = _students(periods).groupBy(*keys).agg(*[F.count_if(F.col("period") == p).alias(n) for p, n in ((1, "baseline"), (2, "second"), (3, "third"))])
    pair = lambda a, b: (F.col("left_period") == a) & (F.col("right_period") == b)
    per_row = matches.groupBy(*keys, "left_period", "left_row").agg(*[F.count_if(pair(a, b)).alias(f"m{a}{b}") for a, b in ((1, 2), (1, 3), (2, 3))])
    found = per_row.groupBy(*keys).agg(
        F.sum("m12").alias("m12"), F.sum("m13").alias("m13"), F.sum("m23").alias("m23"), F.count_if((F.col("m12") > 0) & (F.col("m13") > 0)).alias("both")
    )
    got = _sections(periods, keys).join(sizes, keys, "left").join(found, keys, "left").na.fill(0, ["baseline", "second", "third", "m12", "m13", "m23", "both"])
    based = F.col("has_1") == 1
    first = lambda c: F.when(based, c)
    later = lambda c: F.when(~based, c)
    same = lambda p, m, left: (F.col(f"has_{p}") == 1) & (F.col(left) == F.col(m)) & (F.col("second" if p == 2 else "third") == F.col(m))
    return got.select(
        *keys, based.alias("has_baseline"), (F.col("has_2") == 1).alias("has_second"), (F.col("has_3") == 1).alias("has_third"), "baseline", "second", "third",
        first(F.col("m12")).alias("matched_second"), first(F.col("baseline") - F.col("m12")).alias("missing_second"), first(F.col("second") - F.col("m12")).alias("extra_second"),
        first(same(2, "m12", "baseline")).alias("exact_roster_second"),
        first(F.col("m13")).alias("matched_third"), first(F.col("baseline") - F.col("m13")).alias("missing_third"), first(F.col("third") - F.col("m13")).alias("extra_third"),
        first(same(3, "m13", "baseline")).alias("exact_roster_third"),
        first(F.col("both")).alias("matched_both"), first(F.col("baseline") - F.col("both")).alias("missing_either"),
        later(F.col("m23")).alias("matched_later"), later(F.col("second") - F.col("m23")).alias("only_second"), later(F.col("third") - F.col("m23")).alias("only_third"),
        later((F.col("has_2") == 1) & same(3, "m23", "second")).alias("exact_roster_later"),
    )


def matched_exceptions(periods: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """First-period students that a later period lacks, with the match in the other one, and unmatched later rows.

    Rows of period 1 name what they miss; rows of periods 2 and 3 have no match in the roster they are held against.
    """
    rows = _students(periods)
    names = rows.select(*keys, "period", F.col("row_number").alias("right_row"), F.col("student").alias("name"))
    base = rows.where("period = 1").select(*keys, "period", "student", "row_number")
    for p, side in ((2, "second"), (3, "third")):
        found = matches.where((F.col("left_period") == 1) & (F.col("right_period") == p)).join(names.where(F.col("period") == p).drop("period"), [*keys, "right_row"])
        found = found.select(*keys, F.col("left_row").alias("row_number"), F.col("name").alias(f"{side}_student"), F.col("method").alias(f"{side}_method"), F.col("score").alias(f"{side}_score"))
        base = base.join(found, [*keys, "row_number"], "left")
    no2, no3 = F.col("second_method").isNull(), F.col("third_method").isNull()
    base = base.withColumn("exception_type", F.when(no2 & no3, "Missing from Sheets 2 and 3").when(no2, "Missing from Sheet 2").when(no3, "Missing from Sheet 3")).where("exception_type IS NOT NULL")
    ends = [matches.select(*keys, F.col(f"{s}_period").alias("period"), F.col(f"{s}_row").alias("row_number")) for s in ("left", "right")]
    alone = rows.where("period > 1").join(ends[0].union(ends[1]), [*keys, "period", "row_number"], "left_anti")
    alone = alone.join(_sections(periods, keys).select(*keys, "has_1"), keys).select(
        *keys, "period", "student", "row_number",
        F.when(F.col("has_1") == 1, F.concat(F.lit("Not in Sheet 1, extra in Sheet "), F.col("period"))).otherwise(F.concat(F.lit("No baseline, only in Sheet "), F.col("period"))).alias("exception_type"),
    )
    return base.unionByName(alone, allowMissingColumns=True)


def overview_metrics(sections: DataFrame) -> DataFrame:
    """Totals of the reconciliation as metric and value."""
    sums = [c for c, t in sections.dtypes if t == "bigint"]
    flags = [c for c, t in sections.dtypes if t == "boolean"]
    one = sections.agg(F.count("*").alias("sections"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], *[F.count_if(c).alias(c) for c in flags])
    pairs = ", ".join(f"'{c}', {c}" for c in one.columns)
    return one.selectExpr(f"stack({len(one.columns)}, {pairs}) AS (metric, value)")
