"""One query per operator over the derived tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions import evidence as ev
from rosterline.functions.normalize import normalised_once
from rosterline.functions.similarity import scored_pairs
from rosterline.operators import discovery, duplicates, linkage, missing, relational, reports, review, tracking
from rosterline.operators.scratch import written
from rosterline.plans.fixtures import derived, load

PLACE = ["district", "school"]
SECTION = [*PLACE, "section"]


def entry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster as a file has it: place and section in one cell each, some of them unusable."""
    r = derived(spark, sf_dir, "roster")
    place = F.when(F.col("row_number") % 50 == 0, F.col("school")).otherwise(F.concat_ws(" / ", "district", "school"))
    return r.select("row_number", place.alias("v1"), F.concat(F.lit("4-"), F.upper("section")).alias("v2"), F.when(F.col("row_number") % 40 == 0, " ").otherwise(F.col("student")).alias("v3"))


def roster_split_location(spark, sf_dir):
    return relational.split_location(entry_table(spark, sf_dir), "v1").select("row_number", "district", "school")


def incomplete_counts(spark, sf_dir):
    rows = relational.split_location(entry_table(spark, sf_dir), "v1")
    empty = relational.blank("v3")
    return rows.agg(
        F.count_if(F.col("district").isNotNull() & ~empty).alias("usable"), F.count_if(empty).alias("blank_students"), F.count_if(F.col("district").isNull()).alias("invalid_places"),
    )


def section_normalize(spark, sf_dir):
    rows = entry_table(spark, sf_dir)
    return rows.select("row_number", relational.section_part("v2").alias("section"))


def normalize_ascii(spark, sf_dir):
    rows = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return normalised_once(rows, {"name_key": ("p_name", "match"), "type_key": ("p_type", "match")}).select("p_partkey", "name_key", "type_key")


def forward_fill_context(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).otherwise("").alias("context"), F.when(F.col("turn") % 3 == 0, F.col("role")).alias("speaker"))
    return relational.forward_fill(rows, "conv_id", "turn", ["context", "speaker"])


def missing_sections_anti(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    required = derived(spark, sf_dir, "roster").select(*SECTION).distinct()
    return relational.missing_combinations(required, p.where("period = 3"), SECTION)


def required_section_check(spark, sf_dir):
    return relational.requirement_faults(derived(spark, sf_dir, "roster").select(*SECTION).distinct(), PLACE, "section", 5)


def union_periods(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    sheets = {f"sheet{k}": p.where(f"period = {k}").select("row_number", "student") for k in (1, 2, 3)}
    return relational.union_sheets(sheets)


def append_merge(spark, sf_dir):
    r = derived(spark, sf_dir, "roster").select("district", "student")
    s = derived(spark, sf_dir, "src").select(F.col("school").alias("a"), F.when(F.col("src_row") % 4 == 1, "").otherwise(F.col("student")).alias("b"))
    s = s.withColumn("a", F.when(F.col("b") == "", " ").otherwise(F.col("a")))
    return relational.append_by_position([r, s])


def intersect_both_periods(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    return relational.in_both(p.where("period = 2"), p.where("period = 3"), [*SECTION, "student"])


def partition_check(spark, sf_dir):
    c = linkage.resolve_locations(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))
    s = derived(spark, sf_dir, "src").join(c, PLACE)
    return relational.partition_faults(derived(spark, sf_dir, "src"), s.where("accepted"), s.where("NOT accepted"), "src_row")


def kth_occurrence_join(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return relational.kth_occurrence_pairs(e.where("event_type = 'click'"), e.where("event_type <> 'click'"), ["user_id"], "event_id")


def page_ranges_islands(spark, sf_dir):
    o = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").where("l_linenumber <> 3")
    return relational.range_text(relational.islands(o, ["l_orderkey"], "l_linenumber"), ["l_orderkey"])


def asof_preceding_anchor(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = e.agg(F.min("event_type")).first()[0]
    got = relational.preceding_anchor(e, "user_id", "event_id", F.col("event_type") == F.lit(first))
    return got.select("user_id", "event_id", "anchor", "next_anchor")


def merged_range_lookup(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("sheet"), F.col("o_orderkey").alias("at"))
    c = load(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).alias("sheet"), (F.col("c_custkey") * 10).alias("first_row"), (F.col("c_custkey") * 10 + F.col("c_custkey") % 90).alias("last_row"), "c_custkey")
    return relational.range_lookup(o, c, "sheet", "at", "first_row", "last_row").select("sheet", "at", "c_custkey")


def grades(spark, sf_dir):
    li, p = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(p, F.col("l_partkey") == F.col("p_partkey"))
    order = F.format_string("%04d%012d%04d", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int"))
    return rows.select("l_orderkey", F.substring("p_brand", 7, 1).alias("course"), F.col("l_quantity").cast("int").cast("string").alias("grade"), order.alias("o"))


def course_pivot(spark, sf_dir):
    rows = grades(spark, sf_dir)
    names = sorted(relational.courses_in_order(rows, "course", "o"))
    wide = relational.course_table(rows, ["l_orderkey"], "course", "grade", "o", names)
    return wide.select("l_orderkey", *[F.col(n).alias(f"course_{n}") for n in names])


def coalesce_tables(spark, sf_dir):
    rows = grades(spark, sf_dir).groupBy("l_orderkey", "course").agg(F.max_by("grade", "o").alias("grade"), F.min("o").alias("o"))
    table = rows.where("l_orderkey % 3 <> 0").select("l_orderkey", "course", F.when(F.col("l_orderkey") % 5 == 0, "").otherwise(F.col("grade")).alias("grade"))
    text = rows.where("l_orderkey % 4 <> 0").select("l_orderkey", "course", F.concat("grade", F.lit("t")).alias("grade"))
    return relational.coalesce_grades(table, text, ["l_orderkey", "course"], "grade")


def mode_column_pair(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return relational.most_common(rows, ["l_suppkey"], ["l_returnflag", "l_linestatus"], "o")


def majority_vote(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_linenumber").alias("vote"))
    return relational.most_common(rows, ["l_partkey"], ["vote"])


def dup_exact_normalized(spark, sf_dir):
    p = derived(spark, sf_dir, "period_repeats")
    rows = p.select(F.col("period").alias("sheet"), F.col("row_number").alias("row"), *SECTION, "student", "raw_section", "raw_student")
    got = duplicates.sheet_duplicates(rows, [*SECTION, "student"], [*PLACE, "raw_section", "raw_student"])
    return got.select("sheet", *SECTION, "student", "occurrences", "duplicate_type", "duplicate_group", "rows")


def dup_with_section(spark, sf_dir):
    return relational.duplicate_groups(derived(spark, sf_dir, "roster_repeats"), [*SECTION, "student"], "SC", "row_number")


def dup_without_section(spark, sf_dir):
    return relational.duplicate_groups(derived(spark, sf_dir, "roster"), [*PLACE, "student"], "RC", "row_number")


def duplicate_names_listagg(spark, sf_dir):
    return duplicates.repeated_names(derived(spark, sf_dir, "period_repeats"), ["period", *PLACE], "student", "raw_student", "row_number")


def _reports(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    again = p.where("row_number % 13 = 0").withColumn("row_number", F.col("row_number") + 5000000)
    return p.unionByName(again).select(F.format_string("sheet%d", "period").alias("sheet"), *PLACE, "student", F.upper("student").alias("student_raw"), "row_number")


def availability_wide(spark, sf_dir):
    r = derived(spark, sf_dir, "roster").withColumn("valid", F.col("row_number") % 17 != 0)
    return duplicates.availability(r, _reports(spark, sf_dir), ["sheet1", "sheet2", "sheet3"], [*PLACE, "student"])


def availability_duplicates(spark, sf_dir):
    return duplicates.availability_duplicates(derived(spark, sf_dir, "roster"), _reports(spark, sf_dir), [*PLACE, "student"])


def _units(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")


def _keywords(spark, sf_dir):
    names = load(spark, sf_dir, "nation").select(F.element_at(F.split(F.lower("n_name"), "_"), 1).alias("keyword"))
    return names.unionAll(spark.createDataFrame([("the",), ("of the",), ("und der",), ("de la",)], "keyword string")).distinct()


def keyword_hits(spark, sf_dir):
    return discovery.keyword_hits(_units(spark, sf_dir), _keywords(spark, sf_dir)).select("conv_id", "turn", "keyword")


def keyword_locations(spark, sf_dir):
    return discovery.candidate_locations(keyword_hits(spark, sf_dir), ["conv_id", "keyword"], "turn")


def path_only_hits(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    words = spark.createDataFrame([("com",), ("fr",), ("page",), ("html",)], "keyword string")
    by_path = discovery.keyword_hits(pages.select("page_id", "url"), words, "url").select("page_id", "keyword")
    by_text = discovery.keyword_hits(pages.select("page_id", "html"), words, "html").select("page_id", "keyword")
    return discovery.path_only_hits(by_path, by_text, ["page_id", "keyword"])


def content_hash_duplicates(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "text", (F.col("n_chars") % 7 != 0).alias("ok"))
    return discovery.content_duplicates(d, "text", "doc_id", "ok").select("doc_id", "sha256", "duplicate_of")


def manifest_counts(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select(F.col("lang").alias("status"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return discovery.manifest(d)


def ratio_pairs(spark, sf_dir):
    n, r = load(spark, sf_dir, "nation").select(F.lower("n_name").alias("a")), load(spark, sf_dir, "region").select(F.lower("r_name").alias("b"))
    pairs = n.crossJoin(F.broadcast(r)).unionAll(n.crossJoin(F.broadcast(n.select(F.reverse("a").alias("b")))))
    return scored_pairs(pairs.distinct(), "a", "b")


def ratio_token_sort(spark, sf_dir):
    s = derived(spark, sf_dir, "src").join(derived(spark, sf_dir, "roster").select(F.col("row_number").alias("src_row"), F.col("student").alias("r_student")), "src_row")
    return scored_pairs(s.select("src_row", "student", "r_student"), "student", "r_student", "score", "sorted")


def resolve_location(spark, sf_dir):
    got = linkage.resolve_locations(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))
    return got.select("district", "school", "accepted", "r_district", "r_school", "district_score", "school_score")


def classify_students(spark, sf_dir):
    return linkage.classify_students(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))


def status_rollup(spark, sf_dir):
    s = derived(spark, sf_dir, "src").withColumn("section", F.when(F.col("src_row") % 8 == 0, "").otherwise(F.col("section")))
    got = linkage.classify_students(s, derived(spark, sf_dir, "roster")).join(s.select("src_row", *SECTION), "src_row")
    return linkage.status_counts(got.withColumn("sheet", (F.col("src_row") % 3).cast("string")), lacking=linkage.incomplete(*SECTION))


def best_by_section(spark, sf_dir):
    got = classify_students(spark, sf_dir).where("status = 'red_name'")
    return got.select("src_row", "best_student", "best_score", "best_in_section", "best_in_section_score")


def multiple_candidates(spark, sf_dir):
    return linkage.candidate_rows(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))


def legacy_classify(spark, sf_dir):
    return linkage.legacy_classify(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))


def two_level_resolve(spark, sf_dir):
    return linkage.two_level_resolve(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))


def name_evidence(spark, sf_dir):
    pairs = derived(spark, sf_dir, "src").select("src_row", "student").join(derived(spark, sf_dir, "roster").select(F.col("row_number").alias("src_row"), F.col("student").alias("r_student")), "src_row")
    got = pairs.withColumn("e", ev.evidence("student", "r_student"))
    return got.select("src_row", "e.pattern", "e.rule_score", "e.initials", "e.omitted", "e.anchors", "e.fuzzy_parts")


def assess_pairs(spark, sf_dir):
    return review.assess_candidates(derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster"))


def promote_unmatched(spark, sf_dir):
    return review.promote_unmatched(classify_students(spark, sf_dir), assess_pairs(spark, sf_dir))


def cohort_measures(spark, sf_dir):
    return review.cohort_summary(promote_unmatched(spark, sf_dir).where("baseline_status LIKE 'red%'").withColumn("sheet", (F.col("src_row") % 3).cast("string")))


def _audit_rows(spark, sf_dir):
    return derived(spark, sf_dir, "audit")


def red_improvement(spark, sf_dir):
    return review.red_improvement(_audit_rows(spark, sf_dir))


def cohort_summary(spark, sf_dir):
    red, decision = F.col("baseline_red_reason"), F.col("decision")
    kept = F.when(decision.isin(*review.PROMOTED) & (red != "red_name"), "Review only").otherwise(decision)
    rows = _audit_rows(spark, sf_dir).select("sheet", F.when(F.col("baseline_is_red"), red).otherwise("green").alias("baseline_status"), kept.alias("decision"), (F.col("pattern") != "").alias("review_required"))
    return review.cohort_summary(rows)


def audit_counters(spark, sf_dir):
    return review.audit_counters(_audit_rows(spark, sf_dir), identity=("person",))


def pattern_histogram(spark, sf_dir):
    return review.pattern_histogram(_audit_rows(spark, sf_dir))


def _scored(spark, sf_dir):
    p = derived(spark, sf_dir, "period_repeats").where("row_number < 1000000 OR row_number % 2 = 0")
    k = F.col("row_number") % 1000000
    score = F.when(k % 5 == 0, "3").when(k % 23 == 0, "=A1").when(k % 7 == 0, "2")
    old = p.where("period = 1").select(F.col("row_number").alias("row"), *SECTION, "student", score.alias("score"), (k % 11).cast("int").alias("c1"))
    new = p.where("period = 3").select(F.col("row_number").alias("row"), *SECTION, "student", F.when(k % 35 == 0, "3").when(k % 10 == 0, "9").alias("score"), F.when(k % 12 == 0, -1.0).otherwise((k % 11).cast("double")).alias("c1"))
    return old, new


def transfer_scores(spark, sf_dir):
    old, new = _scored(spark, sf_dir)
    return review.transfer_scores(old, new, [*SECTION, "student"], "score", ["c1"])


def apply_corrections(spark, sf_dir):
    r = derived(spark, sf_dir, "roster")
    source = r.select(F.col("row_number").alias("row"), *SECTION, "student", F.substring("student", 1, 9).alias("short"))
    k = F.col("row_number")
    orders = r.where("row_number % 3 = 0").select(
        *PLACE, "section", F.when(k % 2 == 0, F.col("student")).otherwise("?").alias("student"), F.substring("student", 1, 9).alias("short"),
        F.when(k % 5 == 0, "3,0").when(k % 5 == 1, "2").otherwise("3").alias("score"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("new "), "student")).alias("to_student"),
    )
    return review.apply_corrections(source, orders, [*SECTION, "student"], [*PLACE, "short"], {"student": "to_student"}).select("row", "student", "corrected")


def tracking_exact(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    got = relational.kth_occurrence_pairs(p.where("period = 1"), p.where("period = 2"), [*SECTION, "student"], "row_number")
    return got.select(*SECTION, "student", "left_row_number", "right_row_number")


def tracking_matches(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    return tracking.match_periods(p.where("period = 1"), p.where("period = 2"), SECTION)


def section_reconciliation(spark, sf_dir):
    return tracking.section_reconciliation(derived(spark, sf_dir, "periods"), SECTION)


def student_exceptions(spark, sf_dir):
    return tracking.student_exceptions(derived(spark, sf_dir, "periods"), SECTION)


def overview_metrics(spark, sf_dir):
    return tracking.overview_metrics(section_reconciliation(spark, sf_dir))


def section_reconciliation_matched(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    return tracking.matched_reconciliation(p, tracking.section_matches(p, SECTION).persist(), SECTION)


def student_exceptions_matched(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    return tracking.matched_exceptions(p, tracking.section_matches(p, SECTION).persist(), SECTION)


def overview_metrics_matched(spark, sf_dir):
    return tracking.overview_metrics(section_reconciliation_matched(spark, sf_dir))


def label_clusters(spark, sf_dir):
    s = derived(spark, sf_dir, "src").select(F.lit(1).alias("period"), F.col("src_row").alias("row_number"), F.upper("district").alias("district"), F.upper("school").alias("school"))
    return tracking.label_clusters(s, "school", "school", within=["district"])


def match_report(spark, sf_dir):
    s, r = derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster")
    return reports.match_report(s, linkage.classify_students(s, r), r)


def _sheet():
    return F.concat(F.lit("Sheet "), (F.col("src_row") % 3 + 1).cast("string"))


def mismatch_report(spark, sf_dir):
    s = derived(spark, sf_dir, "src")
    return reports.mismatch_report(s, linkage.classify_students(s, derived(spark, sf_dir, "roster")), _sheet())


def candidates_report(spark, sf_dir):
    s, r = derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster")
    return reports.candidates_report(s, linkage.candidate_rows(s, r), r, _sheet())


def legacy_report(spark, sf_dir):
    return reports.legacy_report(derived(spark, sf_dir, "src"))


def _advice(spark, sf_dir):
    s, r = derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster")
    classified = linkage.legacy_classify(s, r).persist()
    return s, r, classified, linkage.legacy_advice(s, r, classified)


def legacy_advice(spark, sf_dir):
    return _advice(spark, sf_dir)[3]


def legacy_mismatch(spark, sf_dir):
    s, r, classified, advice = _advice(spark, sf_dir)
    return reports.legacy_mismatch(s, classified, advice, r, _sheet())


def mismatch_cohort(spark, sf_dir):
    sheet = mismatch_report(spark, sf_dir).select(*[F.col(f"`{a}`").cast("string").alias(b) for a, b in (("Source Sheet", "sheet"), ("Source District", "district"), ("Source Student Name", "student"), ("Reason Not Matched", "reason"))])
    blank = spark.createDataFrame([(None, "", " ", None), (review.NO_MISMATCH, None, "", None)], sheet.schema)
    return review.mismatch_cohort(sheet.unionByName(blank))


def baseline_red(spark, sf_dir):
    s, r = derived(spark, sf_dir, "src"), derived(spark, sf_dir, "roster")
    own = r.select(F.col("row_number").alias("src_row"), F.col("student").alias("mapped"), F.when(F.col("row_number") % 4 == 0, "nowhere").otherwise(F.col("school")).alias("m_school"), F.col("district").alias("m_district"), F.col("section").alias("m_section"))
    keys = {"district": "m_district", "school": "m_school", "section": "m_section", "student": "mapped"}
    pairs = s.select("src_row", F.col("student").alias("name")).join(own, "src_row").select("src_row", "name", *[F.col(b).alias(a) for a, b in keys.items()])
    pairs = review.mapped_targets(pairs, r, list(keys))
    scored = scored_pairs(pairs.withColumn("target", F.when(F.col("target_row").isNotNull(), F.col("student"))), "name", "target")
    scored = scored.select("src_row", F.col("district").alias("r_district"), F.col("school").alias("r_school"), F.when(F.col("target").isNotNull(), F.col("score")).alias("score"))
    return review.baseline_red_reason(scored, linkage.classify_students(s, r))


def period_faults(spark, sf_dir):
    return tracking.period_faults(derived(spark, sf_dir, "sheet_rows")).select("period", "row_number", "section_key", "issue_type", "kept")


def data_issues(spark, sf_dir):
    return tracking.data_issues(tracking.period_faults(derived(spark, sf_dir, "sheet_rows")))


def comparison_plan(spark, sf_dir):
    return tracking.comparison_plan(derived(spark, sf_dir, "tracked"), SECTION)


def _tracked(spark, sf_dir):
    p = written(derived(spark, sf_dir, "tracked"))
    return p, written(tracking.section_matches(p, SECTION))  # both are read several times by what follows


def section_sheet(spark, sf_dir):
    p, found = _tracked(spark, sf_dir)
    return reports.section_sheet(tracking.matched_reconciliation(p, found, SECTION))


def unmatched_candidates(spark, sf_dir):
    p, found = _tracked(spark, sf_dir)
    return tracking.residuals(p, found, SECTION).drop("other_second")


def later_rows(spark, sf_dir):
    p, found = _tracked(spark, sf_dir)
    return reports.later_rows(tracking.residuals_by_pair(p, found, SECTION), p.select(*SECTION, "period", F.col("row_number").alias("row"), "student"), SECTION)


def match_review(spark, sf_dir):
    p, found = _tracked(spark, sf_dir)
    return tracking.match_review(p, found, SECTION)


def tracking_overview(spark, sf_dir):
    p, found = _tracked(spark, sf_dir)
    rest = tracking.residuals_by_pair(p, found, SECTION)
    later = reports.later_rows(rest, p.select(*SECTION, "period", F.col("row_number").alias("row"), "student"), SECTION)
    issues = tracking.match_review(p, found, SECTION, rest).select("status").unionByName(data_issues(spark, sf_dir).select("status"))
    repeated = duplicates.repeated_names(p.where("student <> ''"), ["period", *SECTION], "student", "student", "row_number")
    exceptions = tracking.matched_exceptions(p, found, SECTION).where("period = 1")
    return reports.overview(tracking.matched_reconciliation(p, found, SECTION), exceptions, later, repeated, issues)


def institution_ids(spark, sf_dir):
    p = derived(spark, sf_dir, "periods")
    late = F.col("period") == 2
    rows = p.select(
        "period", "row_number", F.when(late, F.concat(F.upper("district"), F.lit(" ILCESI"))).otherwise(F.upper("district")).alias("district"),
        F.when(late & (F.col("row_number") % 3 == 0), F.concat(F.upper("school"), F.lit("X"))).otherwise(F.upper("school")).alias("school"),
    )
    return tracking.institutions(rows)


def _scanned(spark, sf_dir):
    rows = derived(spark, sf_dir, "sheet_rows").select(F.format_string("sheet%d", "period").alias("sheet"), "district", F.when(F.col("row_number") % 37 == 0, F.concat("school", F.lit("q"))).otherwise(F.col("school")).alias("school"), "section")
    required = derived(spark, sf_dir, "roster").select(*PLACE, F.upper("section").alias("section")).distinct()
    return rows, required, missing.scanned(rows, linkage.two_level_resolve(rows, required).persist())


def scan_counts(spark, sf_dir):
    return missing.scan_counts(_scanned(spark, sf_dir)[2])


def missing_by_sheet(spark, sf_dir):
    rows, required, scanned = _scanned(spark, sf_dir)
    return missing.missing_sections(required, scanned, rows)


def missing_entries(spark, sf_dir):
    r = derived(spark, sf_dir, "roster")
    n = F.col("row_number")
    title = F.when(n % 3 == 0, "3. Sinif 1. Donem").when(n % 3 == 1, "4 SINIF").otherwise("3 sinif 2")
    rows = r.select(title.alias("sheet"), "row_number", "district", F.concat(F.initcap("school"), F.lit(" Ilkokulu")).alias("school"), F.when(n % 5 == 0, "ab").when(n % 7 == 0, "").otherwise(F.concat(F.lit("4 / "), "section")).alias("section"))
    return missing.missing_entries(rows)


def text_evidence(spark, sf_dir):
    r = derived(spark, sf_dir, "roster")
    n = F.col("row_number")
    text = F.concat(F.lit("Puan 4"), F.when(n % 2 == 0, " - ").otherwise("/"), F.upper("section"), F.lit(" listesi "), F.when(n % 3 == 0, "3 sinif, 2. DONEM not").otherwise(F.col("student")))
    got = r.select("row_number", missing.text_evidence(text).alias("e"))
    return got.select("row_number", *[F.array_join(f"e.{c}", ",").alias(c) for c in ("grades", "terms", "sections", "grade_headings")])


def sheet_lookup(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    wanted = n.select(F.when(F.col("n_nationkey") % 3 == 0, F.lower("n_name")).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit("?"))).otherwise(F.col("n_name")).alias("sheet"))
    return missing.sheet_lookup(wanted, n.select(F.col("n_name").alias("sheet")))


def roster_problems(spark, sf_dir):
    rows = entry_table(spark, sf_dir).withColumn("v2", F.when(F.col("row_number") % 60 == 0, " ").otherwise(F.col("v2")))
    return missing.roster_problems(rows).select("row_number", "problem")


QUERIES = {
    f.__name__: f
    for f in (
        roster_split_location, incomplete_counts, section_normalize, normalize_ascii, forward_fill_context, missing_sections_anti,
        required_section_check, union_periods, append_merge, intersect_both_periods, partition_check, kth_occurrence_join,
        page_ranges_islands, asof_preceding_anchor, merged_range_lookup, course_pivot, coalesce_tables, mode_column_pair,
        majority_vote, dup_exact_normalized, dup_with_section, dup_without_section, duplicate_names_listagg, availability_wide,
        availability_duplicates, keyword_hits, keyword_locations, path_only_hits, content_hash_duplicates, manifest_counts,
        ratio_pairs, ratio_token_sort, resolve_location, classify_students, status_rollup, best_by_section, multiple_candidates,
        legacy_classify, two_level_resolve, name_evidence, assess_pairs, promote_unmatched, cohort_measures, cohort_summary,
        red_improvement, audit_counters, pattern_histogram, transfer_scores, apply_corrections, tracking_exact, tracking_matches,
        section_reconciliation, student_exceptions, overview_metrics, label_clusters,
        section_reconciliation_matched, student_exceptions_matched, overview_metrics_matched, match_report, mismatch_report, candidates_report,
        legacy_report, legacy_advice, legacy_mismatch, mismatch_cohort, baseline_red, period_faults, data_issues, comparison_plan, section_sheet,
        unmatched_candidates, institution_ids, scan_counts, missing_by_sheet, missing_entries,
        text_evidence, sheet_lookup, roster_problems,
    )
}
