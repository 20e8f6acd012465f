"""Linking source students to a roster: location first, then the name inside the location."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.functions.similarity import scored_pairs, sorted_ratio
from rosterline.operators.nearest import Side, best_two, by_text, candidate_pairs, in_blocks, similar_pairs


@dataclass(frozen=True)
class Policy:
    """Names must score over ``student``; both parts of a location at least ``location``."""

    student: float = 90.0
    location: float = 95.0

    def __post_init__(self):
        if not all(0 <= x <= 100 for x in (self.student, self.location)):
            raise ValueError("thresholds lie between 0 and 100")


_RANKED = "district string, school string, r_district string, r_school string, exact int, worse double, mean double, school_score double, district_score double, first_row long, eligible int"


def _best_locations(wanted: DataFrame, locations: DataFrame, threshold: float, rows: int | None) -> DataFrame:
    """For each wanted location the best of a block of ``locations`` at all and the best that is eligible.

    What is rated first is the worse of two scores, so its bound is the worse of two bounds; the search ends where that
    falls below the best found.
    """

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        districts, schools, first = b["r_district"].tolist(), b["r_school"].tolist(), b["first_row"].tolist()
        names = sorted(set(districts))
        at = np.array([bisect_left(names, d) for d in districts])
        district_side, school_side = Side(names), Side(schools)
        out = []
        for district, group in a.groupby("district", sort=False):
            own = district_side.against(district)
            for school in group["school"].tolist():
                held = school_side.against(school)
                bound = np.minimum(held.bound, own.bound[at])
                best: dict[int, tuple] = {}
                for k in np.argsort(-bound, kind="stable").tolist():
                    # an eligible location is rated over all others, so none is left either
                    if best and bound[k] < best[0][0][1]:
                        break
                    x, y = own.score(at[k]), held.score(k)
                    rank = (int((district, school) == (districts[k], schools[k])), min(x, y), (x + y) / 2.0, y, x, -first[k])
                    for kind in range(1 + (x >= threshold and y >= threshold)):
                        best[kind] = max(best.get(kind, ()), (rank, k))
                out += [(district, school, districts[k], schools[k], *rank[:5], -rank[5], kind) for kind, (rank, k) in best.items()]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _RANKED.split(", ")])

    renamed = locations.select(F.col("district").alias("r_district"), F.col("school").alias("r_school"), "first_row")
    return in_blocks(wanted, renamed, [], "school", "first_row", work, _RANKED, rows)


def resolve_locations(source: DataFrame, roster: DataFrame, policy: Policy = Policy(), rows: int | None = None) -> DataFrame:
    """One row per distinct source location: accepted, the resolved or else the best location, both scores, reason.

    A location that is in the roster as it stands resolves by an equi-join; only the rest are compared,
    in blocks of ``rows``, with the roster locations.
    """
    locations = roster.groupBy("district", "school").agg(F.min("row_number").alias("first_row"))
    wanted = source.select(F.coalesce("district", F.lit("")).alias("district"), F.coalesce("school", F.lit("")).alias("school")).distinct()
    full = wanted.where("district <> '' AND school <> ''")
    exact = full.join(locations, ["district", "school"]).select(
        "district", "school", F.lit(True).alias("accepted"), F.col("district").alias("r_district"), F.col("school").alias("r_school"),
        F.lit(100.0).alias("district_score"), F.lit(100.0).alias("school_score"), F.lit("").alias("reason"),
    )
    rest = full.join(locations, ["district", "school"], "left_anti")
    scored = _best_locations(rest, locations, policy.location, rows)
    rank = F.struct("eligible", "exact", "worse", "mean", "school_score", "district_score", (-F.col("first_row")).alias("back"), "r_district", "r_school")
    best = scored.groupBy("district", "school").agg(F.max(rank).alias("b")).select("district", "school", "b.*")
    t = policy.location
    low = F.concat_ws(
        "; ",
        F.when(F.col("district_score") < t, F.format_string(f"district similarity %.2f%% is below {t:.2f}%%", F.bround("district_score", 2))),
        F.when(F.col("school_score") < t, F.format_string(f"school similarity %.2f%% is below {t:.2f}%%", F.bround("school_score", 2))),
    )
    fuzzy = best.select(
        "district", "school", (F.col("eligible") == 1).alias("accepted"), "r_district", "r_school", "district_score", "school_score",
        F.when(F.col("eligible") == 1, "").otherwise(F.concat(F.lit("Location not accepted: "), low, F.lit("."))).alias("reason"),
    )
    fields = F.concat_ws(", ", F.when(F.col("district") == "", "district"), F.when(F.col("school") == "", "school"))
    lacking = wanted.where("district = '' OR school = ''").select(
        "district", "school", F.lit(False).alias("accepted"), F.lit(None).cast("string").alias("r_district"), F.lit(None).cast("string").alias("r_school"),
        F.lit(0.0).alias("district_score"), F.lit(0.0).alias("school_score"),
        F.concat(F.lit("Missing source field(s): "), fields, F.lit(".")).alias("reason"),
    )
    found = exact.unionByName(fuzzy).unionByName(lacking)
    # with an empty roster nothing was compared at all
    none = full.join(found.select("district", "school"), ["district", "school"], "left_anti").select(
        "district", "school", F.lit(False).alias("accepted"), F.lit(None).cast("string").alias("r_district"), F.lit(None).cast("string").alias("r_school"),
        F.lit(0.0).alias("district_score"), F.lit(0.0).alias("school_score"),
        F.lit("The ERC list contains no usable district-school locations.").alias("reason"),
    )
    return found.unionByName(none)


def candidates(source: DataFrame, roster: DataFrame, resolved: DataFrame, floor: float, **wanted: float) -> DataFrame:
    """Pairs of ``candidate_pairs`` at the resolved location of every source row, with the names and section of both sides."""
    placed = source.join(resolved.where("accepted").select("district", "school", "r_district", "r_school"), ["district", "school"])
    people = roster.select(
        F.col("district").alias("r_district"), F.col("school").alias("r_school"), F.col("section").alias("r_section"),
        F.col("student").alias("r_student"), F.col("row_number").alias("r_row"),
    )
    pairs = candidate_pairs(placed.select("r_district", "r_school", "src_row", "section", "student"), people, ["r_district", "r_school"], floor, **wanted)
    return pairs.join(source.select("src_row", F.coalesce("section", F.lit("")).alias("section"), "student"), "src_row")


def classify_students(source: DataFrame, roster: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Status of every source row: green, yellow, orange, red_name or red_location, with the match or the nearest names.

    One candidate over the limit in the same section is green, in another yellow; several are orange. Of
    red names the best in the own section and the best overall are kept. Repeated roster rows count as
    candidates of their own.
    """
    resolved = resolve_locations(source, roster, policy)
    pairs = candidates(source, roster, resolved, policy.student, nearest_below=policy.student)
    same = (F.col("section") != "") & (F.col("section") == F.col("r_section"))
    rank = F.struct(F.col("score").alias("score"), same.cast("int").alias("same"), (-F.col("r_row")).alias("back"), F.col("r_section"), F.col("r_student"))
    over = F.col("score") > policy.student
    per = pairs.groupBy("src_row").agg(
        F.count_if(over).alias("n_over"), F.max(F.when(over, rank)).alias("hit"), F.max(rank).alias("best"), F.max(F.when(same, rank)).alias("own"),
    )
    rows = source.join(resolved, ["district", "school"], "left").join(per, "src_row", "left")
    n = F.coalesce("n_over", F.lit(0))
    status = (
        F.when(~F.coalesce("accepted", F.lit(False)), "red_location").when(n == 0, "red_name").when(n > 1, "orange")
        .when(F.col("hit.same") == 1, "green").otherwise("yellow")
    )
    single = F.col("status").isin("green", "yellow")
    return rows.withColumn("status", status).select(
        "src_row", "status", F.when(F.col("accepted"), n).otherwise(0).cast("long").alias("n_candidates"), "r_district", "r_school",
        F.when(single, F.col("hit.r_student")).alias("matched_student"), F.when(single, F.col("hit.r_section")).alias("matched_section"),
        F.when(single, -F.col("hit.back")).alias("matched_row"), F.when(single, F.col("hit.score")).alias("score"),
        F.when(F.col("status") == "red_name", F.col("best.r_student")).alias("best_student"),
        F.when(F.col("status") == "red_name", F.col("best.score")).alias("best_score"),
        F.when(F.col("status") == "red_name", F.col("best.r_section")).alias("best_section"),
        F.when(F.col("status") == "red_name", F.col("own.r_student")).alias("best_in_section"),
        F.when(F.col("status") == "red_name", F.col("own.score")).alias("best_in_section_score"),
        "district_score", "school_score", "reason",
    )


def candidate_rows(source: DataFrame, roster: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row per candidate of the source rows that have several, ranked by score, own section, roster row."""
    pairs = candidates(source, roster, resolve_locations(source, roster, policy), policy.student).where(F.col("score") > policy.student)
    same = (F.col("section") != "") & (F.col("section") == F.col("r_section"))
    each = Window.partitionBy("src_row")
    ranked = pairs.withColumns({
        "n_candidates": F.count("*").over(each),
        "candidate_rank": F.row_number().over(each.orderBy(F.desc("score"), F.desc(same), "r_row")),
    })
    return ranked.where("n_candidates > 1").select("src_row", "candidate_rank", "n_candidates", "r_row", "r_section", "r_student", "score")


def incomplete(*fields: str) -> Column:
    """Whether any field of a source row is blank; such rows have a status all the same."""
    empty = F.lit(False)
    for f in fields:
        empty = empty | (F.trim(F.coalesce(f, F.lit(""))) == "")
    return empty


def status_counts(classified: DataFrame, sheet: str = "sheet", lacking: Column | None = None) -> DataFrame:
    """Rows per status and sheet, and over all sheets (null); red is the sum of both reds, incomplete counts rows that lack a field."""
    count = {s: F.count_if(F.col("status") == s).alias(s) for s in ("green", "yellow", "orange", "red_location", "red_name")}
    lacking = F.lit(False) if lacking is None else lacking
    got = classified.withColumn("__lacking", lacking).rollup(sheet).agg(F.count("*").alias("total"), *count.values(), F.count_if("__lacking").alias("incomplete"))
    return got.withColumn("red", F.col("red_location") + F.col("red_name"))


def legacy_classify(source: DataFrame, roster: DataFrame, student: float = 88.0, location: float = 90.0) -> DataFrame:
    """The older policy: exact on all four keys, else the best name, at least ``student``, at the best location of the section.

    A location needs both parts at least ``location`` and is weighed 0.35 district, 0.65 school. Of equal names the first
    roster row counts. The location a row was looked up at comes along, null where none will do.
    """
    place = ["district", "school", "section"]
    exact = roster.groupBy(*place, "student").agg(F.min("row_number").alias("exact_row"))
    places = roster.select(*place).distinct().withColumn("here", F.lit(True))
    want = source.select(*place).distinct().where("district <> '' AND school <> '' AND section <> ''").join(places, place, "left_anti")
    near = want.join(places.select(F.col("district").alias("n_district"), F.col("school").alias("n_school"), "section"), "section")
    near = scored_pairs(near, "district", "n_district", "d_score", "sorted").where(F.col("d_score") >= location)
    near = scored_pairs(near, "school", "n_school", "s_score", "sorted").where(F.col("s_score") >= location)
    weight = F.col("d_score") * 0.35 + F.col("s_score") * 0.65
    near = near.groupBy(*place).agg(F.min(F.struct((-weight).alias("w"), "n_district", "n_school")).alias("near"))
    rows = source.join(exact, [*place, "student"], "left").join(places, place, "left").join(near, place, "left")
    rows = rows.select(
        "src_row", "student", "section", "exact_row", F.when(F.col("here"), F.col("district")).otherwise(F.col("near.n_district")).alias("r_district"),
        F.when(F.col("here"), F.col("school")).otherwise(F.col("near.n_school")).alias("r_school"),
    )
    people = roster.select(F.col("district").alias("r_district"), F.col("school").alias("r_school"), "section", F.col("student").alias("r_student"), F.col("row_number").alias("r_row"))
    open_rows = rows.where("exact_row IS NULL AND r_district IS NOT NULL").select("src_row", "student", "section", "r_district", "r_school")
    pairs = similar_pairs(open_rows, people, ["r_district", "r_school", "section"], "src_row", "student", "r_row", "r_student", student, "sorted")
    pairs = pairs.select("src_row", "r_row", "score").join(people.select("r_row", "r_student"), "r_row")
    best = pairs.groupBy("src_row").agg(F.min(F.struct((-F.col("score")).alias("s"), "r_row", "r_student")).alias("best"))
    is_exact = F.col("exact_row").isNotNull()
    return rows.join(best, "src_row", "left").select(
        "src_row", F.when(is_exact, "exact").when(F.col("best").isNotNull(), "fuzzy").otherwise("unmatched").alias("status"),
        F.when(is_exact, F.col("student")).otherwise(F.col("best.r_student")).alias("matched_student"),
        F.when(is_exact, 100.0).otherwise(-F.col("best.s")).alias("score"), "r_district", "r_school",
    )


def legacy_advice(source: DataFrame, roster: DataFrame, classified: DataFrame, student: float = 88.0, location: float = 90.0) -> DataFrame:
    """(src_row, best_row, best_score, reason) of the rows that ``legacy_classify`` leaves unmatched.

    Where a location was found the best name is sought there, else in the section, else, if no roster row has the
    section, in the whole roster; of equal names the one of the better location, then the first row. A row without a
    name gets none.
    """
    fields = ("district", "school", "section", "student")
    open_rows = source.join(classified.where("status = 'unmatched'").select("src_row", "r_district", "r_school"), "src_row")
    for c in fields:
        open_rows = open_rows.withColumn(c, F.coalesce(c, F.lit("")))
    people = roster.select(*[F.col(c).alias(f"r_{c}") for c in fields], F.col("row_number").alias("r_row"))
    known = people.select(F.col("r_section").alias("section")).distinct().withColumn("known", F.lit(True))
    open_rows = open_rows.join(known, "section", "left").withColumn("lacking", incomplete(*fields))
    placed = ~F.col("lacking") & F.col("r_district").isNotNull()
    named = open_rows.where("student <> ''")
    parts = (
        (named.where(placed), people.withColumn("section", F.col("r_section")), ["r_district", "r_school", "section"]),
        (named.where(~placed & F.col("known")), people.withColumn("section", F.col("r_section")), ["section"]),
        (named.where(~placed & F.col("known").isNull()), people, []),
    )
    found = None
    for rows, others, keys in parts:
        more = _advised(rows.select("src_row", "district", "school", "section", "student", "r_district", "r_school"), others, keys)
        found = more if found is None else found.unionByName(more)
    best = found.groupBy("src_row").agg(F.max(F.struct("best_score", "place", (-F.col("best_row")).alias("back"))).alias("b"))
    lacks = F.concat_ws(", ", *[F.when(F.col(c) == "", "student name" if c == "student" else c) for c in fields])
    score = F.coalesce(F.col("b.best_score"), F.lit(0.0))
    reason = (
        F.when(F.col("lacking"), F.concat(F.lit("Missing source field(s): "), lacks, F.lit(".")))
        .when(F.col("known").isNull(), "No base records exist for this section; the displayed best name was searched across all base sections.")
        .when(F.col("r_district").isNull(), f"District and/or school did not meet the {location:.1f}% location threshold.")
        .otherwise(F.concat(F.lit("Best name similarity ("), F.format_string("%.1f", F.bround(score, 1)), F.lit(f"%) is below the {student:.1f}% student threshold.")))
    )
    return open_rows.join(best, "src_row", "left").select("src_row", (-F.col("b.back")).alias("best_row"), score.alias("best_score"), reason.alias("reason"))


#: Rows to be advised that meet in one task: the searched side is dealt to all of their blocks.
ADVISED_ROWS = 16_000
_ADVISED = "src_row long, best_row long, best_score double, place double"


def _word_scores(rows: DataFrame, people: DataFrame, keys: list[str]) -> DataFrame:
    """(src_row, least): the score of the best of some names that share a word with a row's, one per word; a row's best name has this at least."""
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    first = people.select(*keys, "r_student", words("r_student").alias("__word")).groupBy(*keys, "__word").agg(F.min("r_student").alias("__name"))
    pairs = rows.select(*keys, "src_row", "student", words("student").alias("__word")).where("__word <> ''").join(first, [*keys, "__word"])
    return scored_pairs(pairs, "student", "__name", "least", "sorted").groupBy("src_row").agg(F.max("least").alias("least"))


def _advised(rows: DataFrame, people: DataFrame, keys: list[str]) -> DataFrame:
    """Best name per row and pair of blocks, with the score of its location; a block with nothing as good as ``_word_scores`` gives none."""

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        numbers, districts, schools = b["r_row"].tolist(), b["r_district"].tolist(), b["r_school"].tolist()
        side, out, known = Side(b["r_student"].tolist(), "sorted"), [], {}

        def place(district: str, school: str, k: int) -> float:
            at = (district, school, districts[k], schools[k])
            if at not in known:
                known[at] = sorted_ratio(district, districts[k]) * 0.35 + sorted_ratio(school, schools[k]) * 0.65
            return known[at]

        for text, group in by_text(a, "student", "src_row", "district", "school", "least"):
            held = side.against(text)
            for row, district, school, least in group:
                for k in held.best(1, lambda k: (place(district, school, k), -numbers[k]), least=least):  # noqa: B023
                    out.append((row, numbers[k], held.score(k), place(district, school, k)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _ADVISED.split(", ")])

    if "r_district" in keys:
        own = rows.withColumn("least", F.lit(0.0))
    else:
        own = rows.drop("r_district", "r_school")
        own = own.join(_word_scores(own, people, keys), "src_row", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    return in_blocks(own, people, keys, "src_row", "r_row", work, _ADVISED, left_rows=ADVISED_ROWS)


def unique_best(pairs: DataFrame, keys: list[str], candidate: str, score: str, threshold: float, margin: float) -> DataFrame:
    """Best candidate per key with outcome: fuzzy, unmatched below the threshold, ambiguous within the margin of the next."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.desc(candidate))
    ranked = pairs.withColumns({"__r": F.row_number().over(order), "__next": F.lead(score).over(order)}).where("__r = 1")
    outcome = F.when(F.col(score) < threshold, "unmatched").when(F.col(score) - F.col("__next") < margin, "ambiguous").otherwise("fuzzy")
    return ranked.select(*keys, candidate, score, outcome.alias("outcome"))


def two_level_resolve(source: DataFrame, reference: DataFrame, district: float = 90.0, school: float = 92.0, margin: float = 3.0) -> DataFrame:
    """Status of every distinct source location: the pair as it is, else the district, then the school inside it.

    exact, fuzzy, ambiguous or unmatched; a school that is as it should be under a fuzzy district is fuzzy.
    """
    places = reference.select("district", "school").distinct()
    wanted = source.select("district", "school").distinct()
    known = places.select("district").distinct()
    there = wanted.join(known, "district", "left_semi").withColumns({"r_district": F.col("district"), "d_score": F.lit(100.0), "d_out": F.lit("exact")})
    lost = wanted.join(known, "district", "left_anti").select("district").distinct()
    pairs = best_two(lost, known.select(F.col("district").alias("r_district")), [], "district", "r_district", "key").withColumnRenamed("score", "d_score")
    near = unique_best(pairs, ["district"], "r_district", "d_score", district, margin).withColumnRenamed("outcome", "d_out")
    moved = wanted.join(near, "district")
    rows = there.unionByName(moved.select(*there.columns))
    open_rows = rows.where("d_out IN ('exact', 'fuzzy')")
    inside = places.select(F.col("district").alias("r_district"), F.col("school").alias("r_school"))
    hit = open_rows.join(inside, ["r_district"]).where("school = r_school").select("district", "school", "r_district", "r_school", "d_score", F.lit(100.0).alias("s_score"), F.col("d_out").alias("status"))
    rest = open_rows.join(hit.select("district", "school"), ["district", "school"], "left_anti")
    scored = best_two(rest.select("r_district", "school"), inside, ["r_district"], "school", "r_school", "key").withColumnRenamed("score", "s_score")
    best = rest.join(unique_best(scored, ["r_district", "school"], "r_school", "s_score", school, margin), ["r_district", "school"])
    second = best.select("district", "school", "r_district", F.when(F.col("outcome") == "fuzzy", F.col("r_school")).alias("r_school"), "d_score", "s_score", F.col("outcome").alias("status"))
    shut = rows.where("d_out NOT IN ('exact', 'fuzzy')").select(
        "district", "school", F.lit(None).cast("string").alias("r_district"), F.lit(None).cast("string").alias("r_school"), "d_score", F.lit(0.0).alias("s_score"), F.col("d_out").alias("status")
    )
    got = hit.unionByName(second).unionByName(shut)
    failed = F.col("status").isin("ambiguous", "unmatched")
    return got.withColumn("r_district", F.when(~failed, F.col("r_district")))
