"""Sheets of the roster report and of the tracking workbook, as projections of what the operators give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.operators.review import NO_MISMATCH
from rosterline.operators.tracking import LABELS

# Headers of the sheets.
MATCH_HEADERS = ("District", "School Name", "Section", "Student Name", "Matched ERC Student Name", "Name Similarity", "ERC Section", "ERC School", "ERC District")
MISMATCH_HEADERS = (
    "Source Sheet", "Source District", "Source School", "Source Section", "Source Student Name", "ERC District", "District Similarity", "ERC School", "School Similarity",
    "Best Candidate in Source Section", "Source-Section Similarity", "Source-Section ERC Section", "Best Candidate Across All Sections", "All-Sections Similarity",
    "All-Sections ERC Section", "Reason Not Matched",
)
CANDIDATE_HEADERS = (
    "Source Sheet", "Source District", "Source School", "Source Section", "Source Student Name", "Matched ERC Student Name", "Name Similarity", "ERC Section", "ERC School", "ERC District",
)
LEGACY_HEADERS = ("District", "School Name", "Section", "Student Name")
LEGACY_MISMATCH_HEADERS = (
    "Source Sheet", "District", "School Name", "Section", "Student Name", "Best Base Student Match", "Name Similarity", "Best Base District", "Best Base School", "Best Base Section",
    "Reason Not Matched",
)
SECTION_HEADERS = (
    "District", "School", "Section", "Comparison Basis", "Sheet 1 Section Available", "Sheet 2 Section Available", "Sheet 3 Section Available", "Sheet 1 Student Count",
    "Sheet 2 Student Count", "Sheet 3 Student Count", "Sheet 1-2 Matched", "Baseline Students Missing from Sheet 2", "Unmatched/Extra Sheet 2 Rows", "Sheet 2 Exact Baseline Roster",
    "Sheet 1-3 Matched", "Baseline Students Missing from Sheet 3", "Unmatched/Extra Sheet 3 Rows", "Sheet 3 Exact Baseline Roster", "Baseline Students Matched in Both Later Sheets",
    "Baseline Students Missing in At Least One Later Sheet", "Sheet 2-3 Matched (No Baseline)", "Only in Sheet 2 (No Baseline)", "Only in Sheet 3 (No Baseline)",
    "Sheet 2-3 Exact Roster Match (No Baseline)",
)
BASELINE, NO_BASELINE = "Sheet 1 baseline", "Sheets 2-3 comparison (no Sheet 1 baseline)"
NO_CANDIDATES = "No students with multiple qualifying candidates were found."

_PERSON = ("r_student", "r_section", "r_school", "r_district")


def _people(roster: DataFrame, prefix: str) -> DataFrame:
    names = {"row_number": "row", "student": "student", "section": "section", "school": "school", "district": "district"}
    return roster.select(*[F.col(c).alias(f"{prefix}_{n}") for c, n in names.items()])


def or_message(df: DataFrame, message: str) -> DataFrame:
    """``df``, or where it has no rows one with the message in its first column."""
    none = df.limit(1).agg(F.count("*").alias("__n")).where("__n = 0")
    return df.unionByName(none.select(*[F.lit(message if k == 0 else None).cast(f.dataType).alias(f.name) for k, f in enumerate(df.schema)]))


def match_report(source: DataFrame, classified: DataFrame, roster: DataFrame) -> DataFrame:
    """One row per source row; only a single match fills the last five columns, so orange and red rows leave them blank."""
    rows = source.join(classified.select("src_row", "matched_row", "score"), "src_row").join(_people(roster, "r"), F.col("matched_row") == F.col("r_row"), "left")
    return rows.select("district", "school", "section", "student", "r_student", F.col("score") / 100.0, "r_section", "r_school", "r_district").toDF(*MATCH_HEADERS)


def mismatch_report(source: DataFrame, classified: DataFrame, sheet: Column) -> DataFrame:
    """Red rows: the best location, resolved or not, and of rows red by name the nearest students in the section and at all."""
    red = classified.where("status LIKE 'red%'").select(
        "src_row", "r_district", "r_school", "district_score", "school_score", "best_student", "best_score", "best_section", "best_in_section", "best_in_section_score", "reason",
    )
    rows = source.withColumn("__sheet", sheet).join(red, "src_row")
    percent = lambda c, there: F.when(F.col(there).isNotNull(), F.col(c) / 100.0)
    got = rows.select(
        "__sheet", "district", "school", "section", "student", "r_district", percent("district_score", "r_district"), "r_school", percent("school_score", "r_school"),
        "best_in_section", F.col("best_in_section_score") / 100.0, F.when(F.col("best_in_section").isNotNull(), F.col("section")), "best_student", F.col("best_score") / 100.0, "best_section", "reason",
    )
    return or_message(got.toDF(*MISMATCH_HEADERS), NO_MISMATCH)


def candidates_report(source: DataFrame, several: DataFrame, roster: DataFrame, sheet: Column) -> DataFrame:
    """One row per candidate of the rows that have several."""
    rows = source.withColumn("__sheet", sheet).join(several.select("src_row", "r_row", "score"), "src_row").join(_people(roster, "p"), F.col("r_row") == F.col("p_row"))
    got = rows.select("__sheet", "district", "school", "section", "student", "p_student", F.col("score") / 100.0, "p_section", "p_school", "p_district")
    return or_message(got.toDF(*CANDIDATE_HEADERS), NO_CANDIDATES)


def legacy_report(source: DataFrame) -> DataFrame:
    """The older report has the four source columns; the status is the colour of the name."""
    return source.select("district", "school", "section", "student").toDF(*LEGACY_HEADERS)


def legacy_mismatch(source: DataFrame, classified: DataFrame, advice: DataFrame, roster: DataFrame, sheet: Column) -> DataFrame:
    """Unmatched rows of the older policy with the best name that can be offered, and why there is no match."""
    rows = source.withColumn("__sheet", sheet).join(classified.where("status = 'unmatched'").select("src_row"), "src_row").join(advice, "src_row", "left")
    rows = rows.join(_people(roster, "p"), F.col("best_row") == F.col("p_row"), "left")
    got = rows.select("__sheet", "district", "school", "section", "student", "p_student", F.col("best_score") / 100.0, "p_district", "p_school", "p_section", "reason")
    return or_message(got.toDF(*LEGACY_MISMATCH_HEADERS), NO_MISMATCH)


def section_sheet(sections: DataFrame) -> DataFrame:
    """The 24 columns of the section sheet from ``matched_reconciliation`` by district, school and section."""
    yes = lambda c: F.when(F.col(c), "Yes").when(~F.col(c), "No")
    return sections.select(
        "district", "school", "section", F.when(F.col("has_baseline"), BASELINE).otherwise(NO_BASELINE), yes("has_baseline"), yes("has_second"), yes("has_third"), "baseline", "second", "third",
        "matched_second", "missing_second", "extra_second", yes("exact_roster_second"), "matched_third", "missing_third", "extra_third", yes("exact_roster_third"), "matched_both", "missing_either",
        "matched_later", "only_second", "only_third", yes("exact_roster_later"),
    ).toDF(*SECTION_HEADERS)


def overview(sections: DataFrame, exceptions: DataFrame, later: DataFrame, duplicates: DataFrame, issues: DataFrame) -> DataFrame:
    """The 24 metrics of the overview (place, metric, value), from the sections and the rows of the other sheets."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    based = F.col("has_baseline")
    own = {
        "Total district-school-section combinations": F.count("*"), "Sections with Sheet 1 baseline": F.count_if(based), "Sections without Sheet 1 baseline": F.count_if(~based),
        "Baseline sections absent from Sheet 2": F.count_if(based & ~F.col("has_second")), "Baseline sections absent from Sheet 3": F.count_if(based & ~F.col("has_third")),
        "Sheet 1 baseline student rows": total(F.when(based, F.col("baseline"))),
        "Baseline students matched in Sheet 2": total("matched_second"), "Baseline students missing from Sheet 2": total("missing_second"),
        "Unmatched/extra Sheet 2 rows in baseline sections": total("extra_second"), "Baseline students matched in Sheet 3": total("matched_third"),
        "Baseline students missing from Sheet 3": total("missing_third"), "Unmatched/extra Sheet 3 rows in baseline sections": total("extra_third"),
        "Baseline students matched in both later sheets": total("matched_both"), "Baseline students missing in at least one later sheet": total("missing_either"),
        "No-baseline Sheet 2 student rows": total(F.when(~based, F.col("second"))), "No-baseline Sheet 3 student rows": total(F.when(~based, F.col("third"))),
        "No-baseline students matched between Sheets 2 and 3": total("matched_later"), "No-baseline rows only in Sheet 2": total("only_second"),
        "No-baseline rows only in Sheet 3": total("only_third"),
    }
    rest = {
        "Student exception rows": (exceptions, F.count("*")), "Unmatched later-record rows": (later, F.count("*")), "Duplicate-name groups": (duplicates, F.count("*")),
        "Matches needing review": (issues, F.count_if(F.col("status") == "Needs review")), "Data-quality issues": (issues, F.count_if(F.col("status") == "Data issue")),
    }
    one = sections.agg(*[v.cast("long").alias(f"m{k}") for k, v in enumerate(own.values())])
    pairs = ", ".join(f"{k}, '{name}', m{k}" for k, name in enumerate(own))
    got = one.selectExpr(f"stack({len(own)}, {pairs}) AS (place, metric, value)")
    for k, (name, (df, count)) in enumerate(rest.items(), len(own)):
        got = got.union(df.agg(count.alias("value")).select(F.lit(k), F.lit(name), "value"))
    return got


def later_rows(rest: dict[tuple[int, int], DataFrame], names: DataFrame, keys: list[str]) -> DataFrame:
    """The sheet of later rows without a match: of ``unmatched`` per pair of periods, the right side against period 1, both sides without it.

    ``names`` (keys, period, row, student) gives the candidate's name.
    """
    got = None
    for (one, two), df in rest.items():
        for side, own, across in (("left", one, two), ("right", two, one)):
            if own == 1:
                continue
            based = one == 1
            basis = "Sheet 1 baseline available" if based else f"No Sheet 1 baseline; compared with Sheet {across}"
            kind = "Unmatched/extra relative to Sheet 1" if based else f"Present only/unmatched in Sheet {own}"
            other = names.where(F.col("period") == across).select(*keys, F.col("row").alias("other"), F.col("student").alias("candidate"))
            rows = df.where(F.col("side") == side).join(other, [*keys, "other"], "left").select(
                F.lit(LABELS[own]).alias("period"), *keys, "student", F.lit(basis).alias("comparison_basis"), F.lit(kind).alias("issue_type"), "candidate",
                F.round("score", 2).alias("candidate_score"), "row",
            )
            got = rows if got is None else got.unionByName(rows)
    return got
