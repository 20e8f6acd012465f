"""Guards, reports, layouts, file sinks, the command line and SQL functions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from rosterline import cli
from rosterline.functions import register_all
from rosterline.functions.evidence import name_evidence
from rosterline.functions.normalize import NORMALISERS
from rosterline.operators import duplicates, layouts, missing, relational, reports, review
from rosterline.sinks import files
from rosterline.sinks.xlsx import sheet_names, write_xlsx
from rosterline.sources import xlsx


def test_promotions_of_rows_that_are_not_red_by_name_are_errors(spark):
    schema = "sheet string, baseline_status string, decision string, review_required boolean"
    good = [("a", "red_name", "Green + review", True), ("a", "red_name", "Review only", True), ("b", "green", "Baseline already nonred", False), ("b", "red_location", "Unchanged red", False)]
    got = {r["sheet"]: r for r in review.cohort_summary(spark.createDataFrame(good, schema)).collect()}
    assert (got["a"]["red_to_green"], got["a"]["not_promoted_by_rules"], got["a"]["red_to_green_percent"]) == (1, 1, 50.0)
    assert (got["b"]["baseline_now_nonred"], got["b"]["red_location_now"], got["b"]["still_red"], got[None]["original_red_records"]) == (1, 1, 1, 4)
    for status in ("green", "red_location", None):
        with pytest.raises(Exception, match="credited"):
            review.cohort_summary(spark.createDataFrame([*good, ("a", status, "Yellow + review", True)], schema)).collect()
    assert review.cohort_summary(spark.createDataFrame([], schema)).where("sheet IS NOT NULL").count() == 0


def test_red_rows_need_a_reason_and_scores_must_not_fall(spark):
    schema = "sheet string, baseline_is_red boolean, baseline_red_reason string, decision string, baseline double, adjusted double, pattern string"
    rows = [("s", True, "red_name", "Green + review", 0.8, 0.97, "x"), ("s", True, "red_name", "Green + review", 0.8, 0.9, "x"), ("s", False, "", "Green + review", 0.8, 0.97, "x")]
    got = review.red_improvement(spark.createDataFrame(rows, schema)).where("sheet = 's'").first()
    assert (got["red_to_green"], got["baseline_red"], got["red_remaining"], got["red_score_increases"], got["name_red_to_green_percent"]) == (1, 2, 1, 2, 50.0)
    with pytest.raises(Exception, match="no red reason"):
        review.red_improvement(spark.createDataFrame([*rows, ("s", True, None, "Unchanged", 0.1, 0.1, "")], schema)).collect()
    assert review.audit_counters(spark.createDataFrame(rows, schema)).first()["crossed_90"] == 2
    for bad in (("s", False, "", "Unchanged", 0.5, 0.4, "x"), ("s", False, "", "Unchanged", 0.5, 0.6, "")):
        with pytest.raises(Exception, match="a score fell"):
            review.audit_counters(spark.createDataFrame([*rows, bad], schema)).collect()


def test_cohort_rows(spark):
    schema = "sheet string, student string, row_number int"
    rows = [("S1", "x", 2), (None, " ", 3), (review.NO_MISMATCH, None, 4)]
    assert [r["sheet"] for r in review.mismatch_cohort(spark.createDataFrame(rows, schema)).collect()] == ["S1"]
    with pytest.raises(Exception, match="no source sheet in row 9"):
        review.mismatch_cohort(spark.createDataFrame([*rows, (" ", "y", 9)], schema)).collect()


def test_exact_keys_tell_kinds_apart(spark):
    df = spark.createDataFrame([(1, 1.0, "1", True, None)], "a int, b double, c string, d boolean, e string")
    keys = df.select(*[review.exact_key(df, c).alias(c) for c in df.columns]).first()
    assert keys["a"] == keys["b"] != keys["c"] and keys["d"] not in (keys["a"], keys["c"]) and keys["e"] == ""


def test_empty_sheets_have_a_message(spark):
    source = spark.createDataFrame([], "src_row long, district string, school string, section string, student string")
    rows = reports.or_message(source.select("district", "src_row"), "nothing").collect()
    assert [tuple(r) for r in rows] == [("nothing", None)]
    assert reports.or_message(spark.createDataFrame([("a", 1)], "d string, n int"), "nothing").count() == 1


def test_numbers_run_over_all_groups(spark):
    df = spark.createDataFrame([(g, k) for g in ("b", "a", None) for k in (3, 1, 2)], "g string, k int")
    got = [tuple(r) for r in relational.numbered(df, ["g"], ["k"], "n").orderBy("n").collect()]
    assert got == [(g, k, 3 * i + k) for i, g in enumerate((None, "a", "b")) for k in (1, 2, 3)]
    rows = spark.createDataFrame([("s", "k", 100_000 * k + n, "x") for k in range(3) for n in (5, 7)] + [("s", "m", 1, "x"), ("s", "m", 250_000, "x")], "sheet string, key string, row int, raw string")
    found = duplicates.sheet_duplicates(rows, ["key"], ["raw"]).orderBy("duplicate_group").collect()
    assert [(r["key"], r["duplicate_group"], r["occurrences"]) for r in found] == [("m", "Ss-D0001", 2), ("k", "Ss-D0002", 6)]


def test_text_evidence_of_odd_texts(spark):
    df = spark.createDataFrame([("3/A ve 4-ı, 12/B",), ("2. DÖNEM 3 sınıf",), (None,), ("",)], "t string")
    got = [r["e"] for r in df.select(missing.text_evidence(F.coalesce("t", F.lit(""))).alias("e")).collect()]
    assert (got[0]["grades"], got[0]["sections"]) == (["3", "4"], ["A", "I"]) and got[2]["grades"] == got[3]["terms"] == []


def test_layout_rules_on_odd_pages():
    courses = ("MATEMATİK", "FEN BİLİMLERİ", "FEN")
    assert layouts.course_of(["x", "fen bilimleri dersi"], courses) == "FEN BİLİMLERİ" and layouts.course_of(["none"], courses) == ""
    assert layouts.school_year("Yıl 2023 - 2024 x") == "2023-2024" and layouts.school_year("") == ""
    for rule in layouts.RULES.values():
        assert list(rule(1, "", [], "f", courses=courses)) == [] and list(rule(9, "\n\n1 x", [[[]], [[None, ""]]], "f", courses=courses)) == []
    table = [["Sıra", "No", "Ad"], ["1", "12", "Ali Can", "85", "", "90,5"], ["2", "13", "Su Ay", "-", "7", ""], ["", "Not Ortalaması", "x", "80"]]
    assert list(layouts.number_rows(table)) == [("12", "ALI CAN", ["85", "", "90.5"]), ("13", "SU AY", ["-", "7", ""])]


def test_files_of_groups_logs_and_payloads(spark, tmp_path):
    assert [files.safe_part(x) for x in (" a/b: c ", "...", "x__y")] == ["a_b_c", "unknown", "x_y"]
    df = spark.createDataFrame([("a/b", "ü,", 1), (None, None, 2)], "g string, t string, n int")
    assert [r[0] for r in df.select(files.file_part("g")).collect()] == ["a_b", "unknown"]
    assert files.write_log(df.select("t", "n"), str(tmp_path / "l.csv")) == 2
    assert (tmp_path / "l.csv").read_bytes() == b'\xef\xbb\xbft,n\r\n"\xc3\xbc,",1\r\n,2\r\n'
    files.write_payload({"a": 1}, {"rows": df}, str(tmp_path / "p.json"))
    got = json.loads((tmp_path / "p.json").read_text())
    assert got == {"a": 1, "rows": [{"g": "a/b", "t": "ü,", "n": 1}, {"g": None, "t": None, "n": 2}]}
    files.write_groups(df, str(tmp_path / "groups"), ["g"])
    assert {p.name for p in (tmp_path / "groups").glob("group=*")} == {"group=a_b", "group=unknown"}


def test_workbook_names_and_width(spark, tmp_path):
    assert sheet_names(["x" * 40, "x" * 31 + "y", "a/b", "A_B"]) == ["x" * 31, "x" * 27 + " (2)", "a_b", "A_B (2)"]
    df = spark.createDataFrame([tuple(range(30))], ", ".join(f"k{n} int" for n in range(30)))
    path = str(tmp_path / "w.xlsx")
    write_xlsx({"x" * 40: df, "x" * 40 + "z": df.select("k1")}, path)
    with pytest.raises(Exception, match="read more columns"):
        xlsx.read_xlsx(spark, path, sheet=1).collect()
    assert xlsx.read_xlsx(spark, path, sheet=1, columns=30).where("row_number = 2").first()["c30"] == "29" and xlsx.read_xlsx(spark, path, sheet=2).count() == 2
    assert xlsx.distinct_sheets(["a", "b", "c"], [None, "3", "b"]) == ["a", "c", "b"]
    with pytest.raises(ValueError, match="twice"):
        xlsx.distinct_sheets(["a", "b", "c"], ["a", None, "1"])


def test_everything_is_there_for_sql(spark):
    names = register_all(spark)
    assert len(names) == len(set(names)) > 20
    row = spark.sql("SELECT normalize_match('ÇAĞRI  Işık') AS k, similarity_ratio('abcd', 'abce') AS s, name_evidence('k samed cil', 'kaan samed cil').rule_score AS r").first()
    assert (row["k"], row["s"], row["r"]) == (NORMALISERS["match"]("ÇAĞRI  Işık"), 75.0, name_evidence("k samed cil", "kaan samed cil").rule_score)
    assert [tuple(r) for r in spark.sql("SELECT * FROM file_units('a.csv', CAST('x,y' AS BINARY))").collect()] == [("file", "", 0, "x,y")]


def test_command_line(spark, tmp_path, capsys):
    roster = spark.createDataFrame([("D / Okul", "4-A", "Kaan Samed Çil"), ("D / Okul", "4-B", "Ayşe Nur Demir"), ("D / Okul", "4-B", "Ayşe Nur Demir"), ("x", "4-A", "No Place")], "v1 string, v2 string, v3 string").coalesce(1)
    base = str(tmp_path / "base.xlsx")
    write_xlsx({"R": roster}, base)
    assert cli.main(["match", base, base, base, "--overwrite"], spark) == 2 and cli.main(["match", base, base, str(tmp_path / "n.xlsx"), "--student-threshold", "101"], spark) == 2
    assert cli.main(["duplicates", base, str(tmp_path / "dup.xlsx")], spark) == 0
    assert xlsx.read_xlsx(spark, str(tmp_path / "dup.xlsx"), sheet="With section").count() == 3
    (tmp_path / "books").mkdir()
    for n in ("b.xlsx", "A.xlsx"):
        write_xlsx({"R": roster}, str(tmp_path / "books" / n))
    assert cli.main(["merge", str(tmp_path / "books"), str(tmp_path / "merged.xlsx")], spark) == 0
    assert xlsx.read_xlsx(spark, str(tmp_path / "merged.xlsx")).count() == 9
    assert "error:" in capsys.readouterr().err


def test_unmatched_candidates_read_written_tables(spark):
    from rosterline.plans import queries

    got = queries.unmatched_candidates(spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # once every table on the way stood in the plan again wherever it was read
    assert len(plan.splitlines()) < 100 and "InMemoryRelation" not in plan
    assert set(got.columns) >= {"side", "row", "student", "other", "score", "second"}
