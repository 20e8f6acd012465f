"""Pair audits, promotions, summaries, and carrying manual scores and corrections over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from rosterline.functions.evidence import FLOOR, evidence
from rosterline.operators.linkage import Policy, candidates, resolve_locations

MARGIN = 5.0
#: What stands in a mismatch sheet that has no rows.
NO_MISMATCH = "No mismatched students were found."


def candidate_evidence(source: DataFrame, roster: DataFrame, policy: Policy = Policy(), margin: float = MARGIN) -> DataFrame:
    """Candidates at the resolved location with evidence and the adjusted score: all that can be evidence or come within ``margin`` of the limit."""
    pairs = candidates(source, roster, resolve_locations(source, roster, policy), policy.student - margin, telling=FLOOR)
    got = pairs.withColumn("e", evidence(F.when(F.col("tells"), F.col("student")), "r_student"))
    return got.withColumn("adjusted", F.greatest("score", F.coalesce("e.rule_score", F.col("score"))))


def assess_candidates(source: DataFrame, roster: DataFrame, policy: Policy = Policy(), margin: float = MARGIN) -> DataFrame:
    """Decision for every patterned candidate of every source row, against its rivals at the location.

    A rule's score counts only without rivals: no other roster row over the limit or with plausible
    evidence, a lead of ``margin``, a known section, and no other row that qualifies. Else the pair is for
    review only and keeps its plain score. Repeated roster rows are rivals of each other. Rows that score less than
    ``margin`` under the limit and are no evidence stand in nobody's way and do not come up.
    """
    pairs = candidate_evidence(source, roster, policy, margin)
    plausible = (F.col("adjusted") > policy.student) | (
        (F.col("e.pattern") != "") & (F.col("e.anchors") >= 2) & ~F.contains(F.col("e.reason"), F.lit("duplication"))
    )
    each = Window.partitionBy("src_row")
    first, second = F.max(F.struct("adjusted", "r_row")).over(each), F.count_if(plausible).over(each)
    rows = pairs.withColumns({"top": first, "plausible": plausible, "n_plausible": second})
    # the best other row: the best of all, or the second best for the best row itself
    order = each.orderBy(F.desc("adjusted"), F.desc("r_row"))
    rows = rows.withColumn("next", F.nth_value("adjusted", 2).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rival = F.when(F.col("top.r_row") == F.col("r_row"), F.col("next")).otherwise(F.col("top.adjusted"))
    over = F.count_if(F.col("adjusted") > policy.student).over(each)
    rows = rows.withColumns({"rival_score": rival, "n_over": over, "rivals": F.col("n_plausible") - F.col("plausible").cast("int")})
    patterned = rows.where(F.col("e.pattern") != "")
    blocked = (
        F.col("e.rule_score").isNull() | (F.col("rivals") > 0) | (F.col("adjusted") - F.coalesce("rival_score", F.lit(0.0)) < margin)
        | (F.col("section") == "") | (F.col("n_over") != 1) | (F.col("adjusted") <= policy.student)
    )
    decision = F.when(blocked, "Review only").when(F.col("section") == F.col("r_section"), "Green + review").otherwise("Yellow + review")
    return patterned.select(
        "src_row", "r_row", "r_student", "r_section", F.col("e.pattern").alias("pattern"), F.col("e.rule_score").alias("rule_score"),
        F.col("score").alias("baseline"), F.when(blocked, F.col("score")).otherwise(F.col("adjusted")).alias("adjusted"), "rivals", decision.alias("decision"),
    )


def promote_unmatched(classified: DataFrame, assessed: DataFrame) -> DataFrame:
    """Outcome per source row: only red names can be promoted, each by at most one candidate.

    Decision: the promotion, "Baseline already nonred", "Review only" where a pattern was found, else "Unchanged red".
    """
    hits = assessed.where("decision LIKE '% + review'").groupBy("src_row").agg(
        F.max(F.struct("adjusted", "decision", "r_student")).alias("p"), F.count("*").alias("n_promoted")
    )
    any_pattern = assessed.groupBy("src_row").agg(F.count("*").alias("n_patterned"))
    rows = classified.select("src_row", "status").join(hits, "src_row", "left").join(any_pattern, "src_row", "left")
    red_name = F.col("status") == "red_name"
    promoted = red_name & (F.col("n_promoted") == 1)
    n = F.when(red_name, F.coalesce("n_patterned", F.lit(0))).otherwise(0)
    decision = (
        F.when(promoted, F.col("p.decision")).when(~F.col("status").isin("red_name", "red_location"), "Baseline already nonred")
        .when(n > 0, "Review only").otherwise("Unchanged red")
    )
    return rows.select(
        "src_row", F.col("status").alias("baseline_status"), decision.alias("decision"), (n > 0).alias("review_required"),
        F.when(promoted, F.col("p.r_student")).alias("promoted_student"),
    )


PROMOTED = ("Green + review", "Yellow + review")


def cohort_summary(rows: DataFrame, sheet: str = "sheet") -> DataFrame:
    """Measures per sheet and over all (null sheet) from summed counts; a rate over nothing is null.

    A promotion of a row whose baseline is not red by name is an error: no rule may take credit for it.
    """
    status, decision = F.col("baseline_status"), F.col("decision")
    promoted = decision.isin(*PROMOTED)
    fault = F.raise_error(F.concat(F.lit("a promotion is credited to a row whose baseline is "), F.coalesce(status, F.lit("unknown"))))
    checked = rows.withColumn("decision", F.when(promoted & ~status.eqNullSafe("red_name"), fault.cast("string")).otherwise(decision))
    red = F.startswith(status, F.lit("red_"))
    got = checked.rollup(sheet).agg(
        F.count("*").alias("original_red_records"), *[F.count_if(decision == d).alias(f"red_to_{d.split()[0].lower()}") for d in PROMOTED],
        F.count_if("review_required").alias("flagged"), F.count_if(red & ~promoted).alias("still_red"),
        F.count_if(~red).alias("baseline_now_nonred"), F.count_if(status == "red_location").alias("red_location_now"),
    )
    n, moved = F.col("original_red_records"), F.col("red_to_green") + F.col("red_to_yellow")
    return got.withColumns({
        "not_promoted_by_rules": n - moved, "red_to_green_percent": F.try_divide(100.0 * F.col("red_to_green"), n), "red_reduction_percent": F.try_divide(100.0 * moved, n),
    })


REASONS = ("red_name", "red_location")


def red_improvement(rows: DataFrame, sheet: str = "sheet", limit: float = 0.9) -> DataFrame:
    """Counters and rates of an audit whose scores are fractions; per sheet and over all (null sheet).

    A row is promoted if its score rose over ``limit``, which is strict. A red row without a red reason is an error.
    """
    red, reason = F.coalesce("baseline_is_red", F.lit(False)), F.col("baseline_red_reason")
    fault = F.raise_error(F.concat(F.lit("a red row has no red reason but "), F.coalesce(reason, F.lit("none")))).cast("string")
    rows = rows.withColumn("baseline_red_reason", F.when(red & ~F.coalesce(reason.isin(*REASONS), F.lit(False)), fault).otherwise(reason))
    rose = F.col("adjusted") > F.col("baseline")
    green, yellow = (red & rose & (F.col("adjusted") > limit) & (F.col("decision") == d) for d in PROMOTED)
    got = rows.rollup(sheet).agg(
        F.count("*").alias("records"), F.count_if(red).alias("baseline_red"), *[F.count_if(red & (reason == r)).alias(r) for r in REASONS],
        F.count_if(green).alias("red_to_green"), F.count_if(yellow).alias("red_to_yellow"), F.count_if(red & rose).alias("red_score_increases"),
        *[F.count_if(green & (reason == r)).alias(f"{r.removeprefix('red_')}_red_to_green") for r in REASONS],
    )
    solved = F.col("red_to_green") + F.col("red_to_yellow")
    percent = lambda part, whole: F.try_divide(100.0 * part, F.col(whole))
    return got.withColumns({
        "red_remaining": F.col("baseline_red") - solved, "red_to_green_percent": percent(F.col("red_to_green"), "baseline_red"),
        "red_reduction_percent": percent(solved, "baseline_red"), "name_red_to_green_percent": percent(F.col("name_red_to_green"), "red_name"),
    })


def audit_counters(rows: DataFrame, limit: float = 0.9, identity: tuple[str, ...] = ()) -> DataFrame:
    """Counters over all audited pairs, and with ``identity`` columns how many different pairs are behind three of them.

    No score may fall, and none may rise without a pattern: either is an error.
    """
    up, down, patterned = F.col("adjusted") > F.col("baseline"), F.col("adjusted") < F.col("baseline"), F.coalesce("pattern", F.lit("")) != ""
    low = F.col("baseline") <= limit
    crossed = up & low & (F.col("adjusted") > limit)
    green, yellow = (crossed & (F.col("decision") == d) for d in PROMOTED)
    distinct = [F.count_distinct(F.when(c, F.struct(*identity))).alias(n) for n, c in (("flagged_pairs", patterned), ("promoted_green_pairs", green), ("increased_pairs", up))] if identity else []
    got = rows.agg(
        F.count("*").alias("records"), F.count_if(low).alias("baseline_at_or_below_90"), F.count_if(up).alias("score_increases"), F.count_if(down).alias("score_decreases"),
        F.count_if(crossed).alias("crossed_90"), F.count_if(green).alias("promoted_green"), F.count_if(yellow).alias("promoted_yellow"),
        F.count_if(~patterned).alias("unrelated_records"), F.count_if(~patterned & up).alias("unrelated_changed"), F.count_if(~up).alias("unchanged_scores"),
        F.count_if(patterned).alias("flagged"), F.count_if(F.col("decision") == "Review only").alias("review_only"), *distinct,
    )
    kept = (F.col("score_decreases") == 0) & (F.col("unrelated_changed") == 0)
    return got.withColumn("records", F.when(kept, F.col("records")).otherwise(F.raise_error(F.lit("a score fell, or rose without a pattern")).cast("long")))


def pattern_histogram(rows: DataFrame) -> DataFrame:
    """Audited pairs per pattern."""
    return rows.where(F.coalesce("pattern", F.lit("")) != "").groupBy("pattern").agg(F.count("*").alias("pairs"))


def mapped_targets(pairs: DataFrame, roster: DataFrame, keys: list[str], row: str = "row_number") -> DataFrame:
    """``pairs`` with ``target_row``: the roster row their mapped ``keys`` name, if just one has them."""
    one = roster.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(row).alias("target_row")).where("__n = 1").drop("__n")
    return pairs.join(one, keys, "left")


def baseline_red_reason(audited: DataFrame, classified: DataFrame, limit: float = 90.0) -> DataFrame:
    """(src_row, reason) of audited pairs (src_row, r_district, r_school, score of the mapped target, null without one).

    red_location where the location fails. Else a target at the resolved location that scores over ``limit`` settles that
    the row is not red; without one it is red by name if no roster row of the location scores over it.
    """
    known = classified.select("src_row", "status", F.col("r_district").alias("__d"), F.col("r_school").alias("__s"))
    rows = audited.join(known, "src_row")
    settled = F.coalesce((F.col("score") > limit) & (F.col("r_district") == F.col("__d")) & (F.col("r_school") == F.col("__s")), F.lit(False))
    reason = F.when(F.col("status") == "red_location", "red_location").when(settled, "").when(F.col("status") == "red_name", "red_name").otherwise("")
    return rows.select("src_row", reason.alias("reason"))


def mismatch_cohort(sheet: DataFrame, source: str = "sheet") -> DataFrame:
    """Rows of a mismatch sheet: wholly blank ones and the placeholder of an empty sheet go; a row without its source sheet is an error."""
    cells = [c for c in sheet.columns if c != "row_number"]
    text = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cells}
    rest = F.concat_ws("", *[text[c] for c in cells if c != cells[0]])
    empty = F.concat_ws("", *text.values()) == ""
    placeholder = (text[cells[0]] == NO_MISMATCH) & (rest == "")
    rows = sheet.where(~empty & ~placeholder)
    lost = F.raise_error(F.concat(F.lit("no source sheet in row "), F.col("row_number").cast("string"))) if "row_number" in sheet.columns else F.raise_error(F.lit("no source sheet in a row"))
    return rows.withColumn(source, F.when(text[source] == "", lost.cast("string")).otherwise(text[source]))


def exact_key(df: DataFrame, column: str) -> Column:
    """Text that two cells share only if they are of one kind and equal; blank for none."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, BooleanType):
        text = F.concat(F.lit("bool:"), c.cast("string"))
    elif isinstance(kind, NumericType):
        # decimals without the zeros behind: 1, 1.0 and 1.00 are one number
        number = F.when(c.cast("decimal(38,12)").isNotNull(), F.regexp_replace(F.regexp_replace(c.cast("decimal(38,12)").cast("string"), "0+$", ""), r"\.$", ""))
        text = F.concat(F.lit("number:"), F.coalesce(number, c.cast("string")))
    elif isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        text = F.concat(F.lit("date:"), c.cast("string"))
    else:
        text = F.when(F.trim(c) != "", F.concat(F.lit("text:"), F.trim(c)))
    return F.coalesce(text, F.lit(""))


def transfer_scores(old: DataFrame, new: DataFrame, keys: list[str], score: str, context: list[str]) -> DataFrame:
    """Outcome for every old row that has a score, and the new row it goes to.

    Checks in this order: a formula instead of a score, a blank identity, an identity that repeats in the
    old rows, none or several in the new ones (all rows count, scored or not), a changed context, another
    score already there. Keys and context are compared as what they are: numbers of all types by value, truth values,
    dates and text as kinds of their own, nulls and blanks as one.
    """
    def key(df: DataFrame) -> DataFrame:
        for k in [*keys, *context]:
            df = df.withColumn(k, exact_key(df, k))
        return df

    sizes = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    left, right = key(old), key(new)
    target = right.select(*keys, F.col("row").alias("new_row"), F.col(score).alias("__there"), *[F.col(c).alias(f"__{c}") for c in context])
    one = target.join(sizes(right, "n_new").where("n_new = 1"), keys).drop("n_new")
    rows = left.where(F.coalesce(F.trim(score), F.lit("")) != "")
    rows = rows.join(sizes(left, "n_old"), keys).join(sizes(right, "n_new"), keys, "left").join(one, keys, "left")
    anonymous = F.lit(True)
    for k in keys:
        anonymous = anonymous & (F.col(k) == "")
    changed = F.lit(False)
    for c in context:
        changed = changed | (F.col(c) != F.col(f"__{c}"))
    there = F.coalesce(F.trim("__there"), F.lit(""))
    outcome = (
        F.when(F.ltrim(score).startswith("="), "formula_scores").when(anonymous, "unsafe_rows").when(F.col("n_old") > 1, "ambiguous_old")
        .when(F.col("n_new").isNull(), "no_exact_match").when(F.col("n_new") > 1, "ambiguous_new").when(changed, "changed_context")
        .when(there == F.trim(score), "already_present").when(there != "", "target_conflicts").otherwise("transferred")
    )
    return rows.select("row", outcome.alias("outcome"), "new_row", F.col(score).alias("score"))


def apply_corrections(source: DataFrame, corrections: DataFrame, exact: list[str], fallback: list[str], values: dict[str, str], score: str = "score", wanted: int = 3) -> DataFrame:
    """Source rows after the instructions whose score is ``wanted``: exact identity first, then the fallback one.

    An instruction without a candidate, or whose identity fits several rows, or that meets another one
    on its row, changes nothing. ``values``: source column -> instruction column.
    """
    right = F.regexp_replace(F.trim(score), ",", ".").try_cast("decimal(18,6)") == wanted
    todo = corrections.where(F.coalesce(right, F.lit(False)))

    def unique(keys: list[str], name: str) -> DataFrame:
        return source.groupBy(*keys).agg(F.count("*").alias("n"), F.min("row").alias(name)).where("n = 1").drop("n")

    filled = F.lit(True)
    for c in values.values():
        filled = filled & (F.coalesce(F.trim(c), F.lit("")) != "")
    todo = todo.where(filled)
    both = todo.join(unique(exact, "__exact"), exact, "left").join(unique(fallback, "__fallback"), fallback, "left")
    placed = both.withColumn("row", F.coalesce("__exact", "__fallback")).where("row IS NOT NULL").select("row", *values.values())
    lonely = placed.groupBy("row").agg(F.count("*").alias("n"), *[F.min(c).alias(f"__{k}") for k, c in values.items()]).where("n = 1")
    got = source.join(lonely, "row", "left")
    return got.select(*[F.coalesce(f"__{c}", c).alias(c) if c in values else F.col(c) for c in source.columns], F.col("n").isNotNull().alias("corrected"))
