"""Command line: ``python -m rosterline.cli COMMAND …``; exit 0 on success, 2 on wrong input."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.normalize import normalised, normalised_once
from rosterline.operators import discovery, duplicates, linkage, relational, reports, review, tracking
from rosterline.sinks.files import write_payload
from rosterline.sinks.xlsx import write_xlsx
from rosterline.sources import units, xlsx


def _sheets(spark: SparkSession, path: str, chosen: Sequence[str | None]) -> list[str]:
    return xlsx.distinct_sheets(list(xlsx.Workbook(path).paths), list(chosen))


def read_roster(spark: SparkSession, path: str, header_row: int = 1) -> DataFrame:
    """Roster rows of the first sheet, with keys and as they are written; wholly blank and unusable rows go."""
    rows = xlsx.named_table(xlsx.read_xlsx(spark, path, sheet=1), ["v1", "v2", "v3"], header_row)
    rows = relational.split_location(rows, "v1", "shown_district", "shown_school").where(F.col("shown_district").isNotNull() & ~relational.blank("v3"))
    keys = {"district": ("shown_district", "match"), "school": ("shown_school", "match"), "section": ("v2", "section"), "student": ("v3", "match")}
    return normalised_once(rows, keys).select("row_number", *keys, "shown_district", "shown_school", F.col("v2").alias("shown_section"), F.col("v3").alias("shown_student"))


def read_periods(spark: SparkSession, path: str, sheets: Sequence[str | None], header_row: int = 1, fill: bool = True) -> DataFrame:
    """Rows of three period sheets: district, school, grade and section in the first columns, the student in the sixth of the first sheet, the fifth of the others.

    With ``fill`` blank cells of the first four columns take what stands above them.
    """
    got = None
    for period, name in enumerate(_sheets(spark, path, sheets), 1):
        raw = xlsx.read_xlsx(spark, path, sheet=name).where(f"row_number > {header_row}")
        rows = raw.select("sheet", "row_number", F.lit(period).alias("period"), *[F.col(f"c{k}").alias(c) for k, c in enumerate(("district", "school", "grade", "section"), 1)], F.col("c6" if period == 1 else "c5").alias("student"))
        rows = relational.forward_fill(rows, "sheet", "row_number", ["district", "school", "grade", "section"]) if fill else rows
        got = rows if got is None else got.unionByName(rows)
    return got


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rows = read_periods(spark, args.source, [None] * 3, args.source_header_row).where(~relational.blank("student"))
    rows = rows.withColumns({f"shown_{c}": F.col(c) for c in ("district", "school", "section", "student")}).withColumn("src_row", F.col("period") * F.lit(10_000_000) + F.col("row_number"))
    keys = {"k_district": ("district", "match"), "k_school": ("school", "match"), "k_section": ("section", "section"), "k_student": ("student", "match")}
    rows = normalised_once(rows, keys)
    return rows.select("src_row", "sheet", *[F.coalesce(f"k_{c}", F.lit("")).alias(c) for c in ("district", "school", "section", "student")], *[f"shown_{c}" for c in ("district", "school", "section", "student")])


def _refuse(args: argparse.Namespace, *inputs: str) -> None:
    if os.path.abspath(args.output) in map(os.path.abspath, inputs):
        raise ValueError("the output would overwrite an input")
    if os.path.exists(args.output) and not args.overwrite:
        raise FileExistsError(f"{args.output} is there already")


def _shown(report: DataFrame, headers: Sequence[str]) -> DataFrame:
    return report.toDF(*headers)


def match(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Roster report: one sheet of matches per period, mismatches, candidates and counts."""
    _refuse(args, args.base, args.source)
    source, roster = _source(spark, args).persist(), read_roster(spark, args.base, args.base_header_row).persist()
    policy = linkage.Policy(args.student_threshold, args.location_threshold)
    classified = linkage.classify_students(source, roster, policy).persist()
    shown = {c: F.col(f"shown_{c}").alias(c) for c in ("district", "school", "section", "student")}
    written = source.select("src_row", "sheet", *shown.values())
    people = roster.select("row_number", *shown.values())
    sheet: Column = F.col("sheet")
    out = {}
    for name in [r[0] for r in source.select("sheet").distinct().orderBy("sheet").collect()]:
        out[name] = reports.match_report(written.where(F.col("sheet") == name), classified, people)
    out["Mismatched Students"] = reports.mismatch_report(written, classified, sheet)
    out["Multiple Candidates"] = reports.candidates_report(written, linkage.candidate_rows(source, roster, policy), people, sheet)
    lacking = classified.join(source.select("src_row", "sheet", "district", "school", "section"), "src_row")
    out["Counts"] = linkage.status_counts(lacking, lacking=linkage.incomplete("district", "school", "section"))
    return write_xlsx(out, args.output, overwrite=args.overwrite)


def track(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Reconciliation workbook of three periods."""
    _refuse(args, args.input)
    rows = tracking.period_faults(read_periods(spark, args.input, (args.sheet_1, args.sheet_2, args.sheet_3), args.header_row, fill=False))
    kept = rows.where("kept")
    keys = normalised_once(kept, {"d": ("district", "strict"), "s": ("school", "strict"), "n": ("student", "strict")})
    keys = keys.select("period", "row_number", F.col("d").alias("district"), F.col("s").alias("school"), F.col("section_key").alias("section"), F.coalesce("n", F.lit("")).alias("student")).persist()
    ids = tracking.institutions(keys, (args.district_threshold, args.district_margin), (args.school_threshold, args.school_margin)).persist()
    placed = keys.join(ids, ["district", "school"]).select("period", "row_number", F.col("district_name").alias("district"), F.col("school_name").alias("school"), "section", "student").persist()
    place = ["district", "school", "section"]
    found = tracking.section_matches(placed, place, args.student_threshold, args.student_margin).persist()
    rest = tracking.residuals_by_pair(placed, found, place)
    names = placed.select(*place, "period", F.col("row_number").alias("row"), "student")
    sections, later = tracking.matched_reconciliation(placed, found, place), reports.later_rows(rest, names, place)
    exceptions = tracking.matched_exceptions(placed, found, place).where("period = 1")
    repeated = duplicates.repeated_names(placed.where("student <> ''"), ["period", *place], "student", "student", "row_number")
    issues = tracking.match_review(placed, found, place, rest, args.student_threshold, args.student_margin).unionByName(tracking.data_issues(rows), allowMissingColumns=True)
    out = {
        "Overview": reports.overview(sections, exceptions, later, repeated, issues), "Section Reconciliation": reports.section_sheet(sections), "Student Exceptions": exceptions,
        "Unmatched Later Records": later, "Duplicate Names": repeated, "Match Review": issues,
    }
    return write_xlsx(out, args.output, order={"Overview": ["place"], "Section Reconciliation": ["District", "School", "Section"]}, overwrite=args.overwrite)


def audit(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Audit of a cohort that was not matched: what the name rules would change, as JSON."""
    _refuse(args, args.report, args.roster)
    headers = ["Source Sheet", "Source District", "Source School", "Source Section", "Source Student Name"]
    raw = xlsx.named_table(xlsx.read_xlsx(spark, args.report, sheet=args.mismatch_sheet), headers)
    raw = raw.drop("sheet").select(F.col("Source Sheet").alias("sheet"), *[F.col(h).alias(h.removeprefix("Source ").lower().replace(" ", "_")) for h in headers[1:]], "row_number")
    cohort = review.mismatch_cohort(raw)
    if args.expected_red_records is not None and cohort.count() != args.expected_red_records:
        raise ValueError(f"{cohort.count()} records instead of {args.expected_red_records}")
    keys = {"d": ("district", "match"), "s": ("school", "match"), "c": ("section", "section"), "n": ("student_name", "match")}
    rows = normalised_once(cohort, keys)
    source = rows.select(F.col("row_number").alias("src_row"), "sheet", *[F.coalesce(k, F.lit("")).alias(v) for k, v in (("d", "district"), ("s", "school"), ("c", "section"), ("n", "student"))]).persist()
    roster = read_roster(spark, args.roster).persist()
    decided = review.promote_unmatched(linkage.classify_students(source, roster), review.assess_candidates(source, roster)).join(source.select("src_row", "sheet"), "src_row").persist()
    summary = [r.asDict() for r in review.cohort_summary(decided).collect()]
    write_payload({"report": args.report, "roster": args.roster, "summary": summary}, {"rows": decided}, args.output)
    return {"rows": decided.count()}


def duplicate_rows(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Roster rows that repeat with their section, and without it."""
    _refuse(args, args.input)
    rows = xlsx.named_table(xlsx.read_xlsx(spark, args.input, sheet=1), ["v1", "v2", "v3"])
    keyed = rows.select("row_number", *[normalised(c, "roster").alias(c) for c in ("v1", "v2", "v3")]).persist()
    with_section, without = (relational.duplicate_groups(keyed, k, p, "row_number") for k, p in ((["v1", "v2", "v3"], "SC"), (["v1", "v3"], "RC")))
    return write_xlsx({"With section": with_section, "Without section": without}, args.output, order={"With section": ["group_id", "row_number"], "Without section": ["group_id", "row_number"]}, overwrite=args.overwrite)


def merge(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Rows of all workbooks of a folder, by position under the header of the first."""
    files = sorted((f for f in os.listdir(args.folder) if f.lower().endswith((".xlsx", ".xlsm")) and not f.startswith("~$")), key=str.lower)
    paths = [os.path.join(args.folder, f) for f in files]
    _refuse(args, *paths)
    width = args.columns
    frames = [xlsx.read_xlsx(spark, p, sheet=args.sheet or 1, columns=width) for p in paths]
    head = frames[0].where("row_number = 1").first()
    cells = [f"c{k}" for k in range(1, width + 1) if head is not None and head[f"c{k}"] is not None]
    rows = relational.append_by_position([f.where("row_number > 1").select(*cells) for f in frames], args.include_blank_rows)
    return write_xlsx({"Merged": rows.toDF(*[head[c] for c in cells])}, args.output, overwrite=args.overwrite)


def discover(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Text units of a folder that name a school, and what was read, as JSON."""
    if os.path.abspath(args.output).startswith(os.path.abspath(args.root) + os.sep):
        raise ValueError("the output lies inside the folder that is searched")
    _refuse(args)
    found = units.read_units(spark, args.root, max_pages=args.max_pdf_pages, max_rows=args.max_excel_rows).persist()
    files = discovery.wanted_files(found.select("path", "sha256", "status").distinct(), [".pdf", ".xlsx", ".xlsm", ".csv", ".tsv", ".docx", ".udf", ".rtf", ".doc"])
    words = spark.createDataFrame([(s,) for s in args.school or ["-"]], "school string").select(discovery.keyword(normalised("school", "search")).alias("keyword"))
    keyed = found.withColumn("key", normalised("text", "search"))
    hits = discovery.keyword_hits(keyed, words, "key")
    places = discovery.candidate_locations(hits, ["path", "kind", "sheet", "keyword"], "number")
    paths = discovery.keyword_hits(files.withColumn("key", normalised("path", "search")), words, "key")
    only = discovery.path_only_hits(paths.select("path", "keyword"), hits, ["path", "keyword"])
    errors = found.where("status = 'error'").select("path", "error")
    write_payload({"root": args.root, "manifest": [r.asDict() for r in discovery.manifest(files).collect()]}, {"candidates": places, "path_only": only, "errors": errors}, args.output)
    return {"candidates": places.count(), "errors": errors.count()}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rosterline")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *inputs: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=(run.__doc__ or "").splitlines()[0])
        for i in inputs:
            p.add_argument(i)
        p.add_argument("output")
        p.add_argument("--overwrite", action="store_true")
        p.set_defaults(run=run)
        return p

    p = command("match", match, "base", "source")
    for flag, default in (("--student-threshold", 90.0), ("--location-threshold", 95.0)):
        p.add_argument(flag, type=float, default=default)
    for flag in ("--source-header-row", "--base-header-row"):
        p.add_argument(flag, type=int, default=1)
    p = command("track", track, "input")
    for k in (1, 2, 3):
        p.add_argument(f"--sheet-{k}")
    p.add_argument("--header-row", type=int, default=1)
    for kind, limit in (("district", 90.0), ("school", 88.0), ("student", 90.0)):
        p.add_argument(f"--{kind}-threshold", type=float, default=limit)
        p.add_argument(f"--{kind}-margin", type=float, default=5.0)
    p = command("audit", audit, "report", "roster")
    p.add_argument("--mismatch-sheet", default="Mismatched Students")
    p.add_argument("--expected-red-records", type=int)
    command("duplicates", duplicate_rows, "input")
    p = command("merge", merge, "folder")
    p.add_argument("--sheet")
    p.add_argument("--columns", type=int, default=26)
    p.add_argument("--include-blank-rows", action="store_true")
    p = command("discover", discover, "root")
    p.add_argument("--school", action="append")
    p.add_argument("--max-pdf-pages", type=int, default=0)
    p.add_argument("--max-excel-rows", type=int, default=0)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        for name, value in vars(args).items():
            if name.endswith("threshold") and not 0 <= value <= 100:
                raise ValueError(f"{name} lies between 0 and 100")
        done = args.run(spark or SparkSession.builder.getOrCreate(), args)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    print(", ".join(f"{k}: {v}" for k, v in done.items()))
    return 2 if done.get("errors") else 0


if __name__ == "__main__":
    sys.exit(main())
