"""DuckDB SQL of the queries that follow students over periods.

The greedy loop is one pass here: on these tables no pair that is taken makes another one clear, which the
comparison itself would show.
"""

from __future__ import annotations

from rosterline.plans.fixtures import oracle, ratio_sql

_SORT = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
_KEYS = "district, school, section"


def matches_sql(table: str) -> str:
    """Common tables over the period table ``table``: st, sec, plan, m (matches of the plan) and left_over with best candidates."""
    return f"""
st AS (SELECT * FROM {table} WHERE trim(student) <> ''),
sec AS (SELECT {_KEYS}, bool_or(period = 1) AS has1, bool_or(period = 2) AS has2, bool_or(period = 3) AS has3 FROM {table} GROUP BY ALL),
plan AS (SELECT {_KEYS}, 1 AS lp, 2 AS rp FROM sec WHERE has1 UNION ALL SELECT {_KEYS}, 1, 3 FROM sec WHERE has1 UNION ALL SELECT {_KEYS}, 2, 3 FROM sec WHERE NOT has1),
num AS (SELECT *, row_number() OVER (PARTITION BY period, {_KEYS}, student ORDER BY row_number) AS k FROM st),
ex AS (
  SELECT {_KEYS}, lp, rp, a.row_number AS l, b.row_number AS r FROM plan JOIN num a USING ({_KEYS}) JOIN num b USING ({_KEYS}, student, k) WHERE a.period = lp AND b.period = rp),
lft AS (SELECT {_KEYS}, lp, rp, row_number AS l, student AS ls FROM plan JOIN st USING ({_KEYS}) WHERE period = lp),
rgt AS (SELECT {_KEYS}, lp, rp, row_number AS r, student AS rs FROM plan JOIN st USING ({_KEYS}) WHERE period = rp),
x AS (
  SELECT * FROM (SELECT * FROM lft ANTI JOIN ex USING ({_KEYS}, lp, rp, l)) JOIN (SELECT * FROM rgt ANTI JOIN ex USING ({_KEYS}, lp, rp, r)) USING ({_KEYS}, lp, rp)),
pairs AS (SELECT DISTINCT a, b FROM (SELECT ls AS a, rs AS b FROM x UNION ALL SELECT {_SORT.format("ls")}, {_SORT.format("rs")} FROM x) WHERE a <> b),
{ratio_sql()},
sc AS (
  SELECT x.*, CASE WHEN ls = rs THEN CAST(100 AS DOUBLE) ELSE greatest(p.score, coalesce(q.score, 100.0)) END AS score
  FROM x LEFT JOIN scores p ON p.a = ls AND p.b = rs LEFT JOIN scores q ON q.a = {_SORT.format("ls")} AND q.b = {_SORT.format("rs")}),
rk AS (
  SELECT *, row_number() OVER wl AS nl, row_number() OVER wr AS nr, coalesce(lead(score) OVER wl, 0) AS sl, coalesce(lead(score) OVER wr, 0) AS sr FROM sc
  WINDOW wl AS (PARTITION BY {_KEYS}, lp, rp, l ORDER BY score DESC, r), wr AS (PARTITION BY {_KEYS}, lp, rp, r ORDER BY score DESC, l)),
m AS (
  SELECT {_KEYS}, lp, rp, l, r, CAST(100 AS DOUBLE) AS score, 'Exact' AS method FROM ex
  UNION ALL
  SELECT {_KEYS}, lp, rp, l, r, score, 'Fuzzy' FROM rk WHERE nl = 1 AND nr = 1 AND score >= 90 AND score - sl >= 5 AND score - sr >= 5),
sc2 AS (SELECT sc.* FROM sc ANTI JOIN m USING ({_KEYS}, lp, rp, l) ANTI JOIN m m2 ON m2.district = sc.district AND m2.school = sc.school AND m2.section = sc.section AND m2.lp = sc.lp AND m2.rp = sc.rp AND m2.r = sc.r),
rk2 AS (
  SELECT *, row_number() OVER wl AS nl, row_number() OVER wr AS nr, coalesce(lead(score) OVER wl, 0) AS sl, coalesce(lead(score) OVER wr, 0) AS sr FROM sc2
  WINDOW wl AS (PARTITION BY {_KEYS}, lp, rp, l ORDER BY score DESC, r), wr AS (PARTITION BY {_KEYS}, lp, rp, r ORDER BY score DESC, l)),
bl AS (SELECT * FROM rk2 WHERE nl = 1), br AS (SELECT * FROM rk2 WHERE nr = 1),
left_over AS (
  SELECT f.{_KEYS.replace(", ", ", f.")}, f.lp, f.rp, 'left' AS side, f.l AS "row", f.ls AS student, bl.r AS other, bl.rs AS candidate, bl.score, bl.sl AS second, br.sr AS other_second
  FROM (SELECT * FROM lft ANTI JOIN m USING ({_KEYS}, lp, rp, l)) f LEFT JOIN bl USING ({_KEYS}, lp, rp, l)
  LEFT JOIN br ON br.district = f.district AND br.school = f.school AND br.section = f.section AND br.lp = f.lp AND br.rp = f.rp AND br.r = bl.r
  UNION ALL
  SELECT f.{_KEYS.replace(", ", ", f.")}, f.lp, f.rp, 'right', f.r, f.rs, br.l, br.ls, br.score, br.sr, NULL
  FROM (SELECT * FROM rgt ANTI JOIN m USING ({_KEYS}, lp, rp, r)) f LEFT JOIN br USING ({_KEYS}, lp, rp, r)),
sizes AS (SELECT {_KEYS}, count(*) FILTER (period = 1) AS c1, count(*) FILTER (period = 2) AS c2, count(*) FILTER (period = 3) AS c3 FROM st GROUP BY ALL),
per AS (SELECT {_KEYS}, l, lp, bool_or(rp = 2) AS in2, bool_or(rp = 3) AS in3 FROM m GROUP BY ALL),
found AS (
  SELECT {_KEYS}, count(*) FILTER (lp = 1 AND in2) AS m12, count(*) FILTER (lp = 1 AND in3) AS m13, count(*) FILTER (lp = 2) AS m23, count(*) FILTER (lp = 1 AND in2 AND in3) AS both_later FROM per GROUP BY ALL),
recon0 AS (
  SELECT s.*, coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2, coalesce(c3, 0) AS c3, coalesce(m12, 0) AS m12, coalesce(m13, 0) AS m13, coalesce(m23, 0) AS m23, coalesce(both_later, 0) AS both_later
  FROM sec s LEFT JOIN sizes USING ({_KEYS}) LEFT JOIN found USING ({_KEYS})),
recon AS (
  SELECT {_KEYS}, has1 AS has_baseline, has2 AS has_second, has3 AS has_third, c1 AS baseline, c2 AS second, c3 AS third,
         CASE WHEN has1 THEN m12 END AS matched_second, CASE WHEN has1 THEN c1 - m12 END AS missing_second, CASE WHEN has1 THEN c2 - m12 END AS extra_second,
         CASE WHEN has1 THEN has2 AND c1 = m12 AND c2 = m12 END AS exact_roster_second,
         CASE WHEN has1 THEN m13 END AS matched_third, CASE WHEN has1 THEN c1 - m13 END AS missing_third, CASE WHEN has1 THEN c3 - m13 END AS extra_third,
         CASE WHEN has1 THEN has3 AND c1 = m13 AND c3 = m13 END AS exact_roster_third,
         CASE WHEN has1 THEN both_later END AS matched_both, CASE WHEN has1 THEN c1 - both_later END AS missing_either,
         CASE WHEN NOT has1 THEN m23 END AS matched_later, CASE WHEN NOT has1 THEN c2 - m23 END AS only_second, CASE WHEN NOT has1 THEN c3 - m23 END AS only_third,
         CASE WHEN NOT has1 THEN has2 AND has3 AND c2 = m23 AND c3 = m23 END AS exact_roster_later FROM recon0),
name2 AS (SELECT * FROM m WHERE lp = 1 AND rp = 2), name3 AS (SELECT * FROM m WHERE lp = 1 AND rp = 3),
lacking AS (
  SELECT s.{_KEYS.replace(", ", ", s.")}, 1 AS period, s.student, s.row_number, n2.student AS second_student, a.method AS second_method, a.score AS second_score, n3.student AS third_student,
         b.method AS third_method, b.score AS third_score,
         CASE WHEN a.l IS NULL AND b.l IS NULL THEN 'Missing from Sheets 2 and 3' WHEN a.l IS NULL THEN 'Missing from Sheet 2' ELSE 'Missing from Sheet 3' END AS exception_type
  FROM st s LEFT JOIN name2 a ON a.district = s.district AND a.school = s.school AND a.section = s.section AND a.l = s.row_number
  LEFT JOIN name3 b ON b.district = s.district AND b.school = s.school AND b.section = s.section AND b.l = s.row_number
  LEFT JOIN st n2 ON n2.period = 2 AND n2.district = s.district AND n2.school = s.school AND n2.section = s.section AND n2.row_number = a.r
  LEFT JOIN st n3 ON n3.period = 3 AND n3.district = s.district AND n3.school = s.school AND n3.section = s.section AND n3.row_number = b.r
  WHERE s.period = 1 AND (a.l IS NULL OR b.l IS NULL)),
later AS (
  SELECT CASE own WHEN 2 THEN '2nd Semester 3rd Grade' ELSE '4th Grade' END AS period, {_KEYS}, student,
         CASE WHEN lp = 1 THEN 'Sheet 1 baseline available' ELSE 'No Sheet 1 baseline; compared with Sheet ' || (5 - own) END AS comparison_basis,
         CASE WHEN lp = 1 THEN 'Unmatched/extra relative to Sheet 1' ELSE 'Present only/unmatched in Sheet ' || own END AS issue_type, candidate, round(score, 2) AS candidate_score, "row"
  FROM (SELECT *, CASE WHEN side = 'left' THEN lp ELSE rp END AS own FROM left_over) WHERE own > 1),
label AS (SELECT * FROM (VALUES (1, '1st Semester 3rd Grade'), (2, '2nd Semester 3rd Grade'), (3, '4th Grade')) AS t(period, name)),
review0 AS (
  SELECT 'Auto-accepted' AS status, method || ' student match' AS issue_type, {_KEYS}, lp, rp, l, r, score, NULL AS second,
         'Mutually best one-to-one candidates above threshold 90.0 with margin at least 5.0.' AS reason FROM m WHERE method <> 'Exact'
  UNION ALL
  SELECT 'Needs review', 'Ambiguous student match', {_KEYS}, lp, rp, "row", other, score, greatest(second, other_second),
         CASE WHEN score < 90 THEN 'Best score is below automatic threshold 90.0.' WHEN score - greatest(second, other_second) < 5 THEN 'Competing candidates are within margin 5.0.'
              ELSE 'The candidate relationship is not mutually best.' END || ' The rows were kept unmatched.' FROM left_over WHERE side = 'left' AND score >= 80),
review AS (
  SELECT status, issue_type, v.{_KEYS.replace(", ", ", v.")}, x1.name || ' vs ' || x2.name AS period, l || ' / ' || r AS source_row, a.student AS original_value, b.student AS candidate_value,
         round(score, 2) AS similarity_score, round(second, 2) AS second_best_score, reason
  FROM review0 v JOIN label x1 ON x1.period = lp JOIN label x2 ON x2.period = rp
  JOIN st a ON a.period = lp AND a.row_number = l AND a.section = v.section AND a.school = v.school AND a.district = v.district
  JOIN st b ON b.period = rp AND b.row_number = r AND b.section = v.section AND b.school = v.school AND b.district = v.district)"""


FAULTS = """
faults0 AS (
  SELECT *, CASE WHEN length(section) = 1 THEN replace(upper(replace(section, 'i', 'İ')), 'ı', 'I') ELSE '' END AS section_key,
         CASE period WHEN 3 THEN 4 ELSE 3 END AS wanted FROM sheet_rows),
faults AS (
  SELECT *, CASE WHEN district = '' OR school = '' OR section = '' THEN 'Incomplete location data' WHEN coalesce(TRY_CAST(replace(grade, ',', '.') AS DOUBLE), -1) <> wanted THEN 'Unexpected grade'
              WHEN section_key = '' THEN 'Invalid section' WHEN student = '' THEN 'Blank student name' ELSE '' END AS issue_type FROM faults0)"""

_T = matches_sql("tracked")
_P = matches_sql("periods")

_METRICS = [
    ("Total district-school-section combinations", "count(*) FROM recon"), ("Sections with Sheet 1 baseline", "count(*) FILTER (has_baseline) FROM recon"),
    ("Sections without Sheet 1 baseline", "count(*) FILTER (NOT has_baseline) FROM recon"), ("Baseline sections absent from Sheet 2", "count(*) FILTER (has_baseline AND NOT has_second) FROM recon"),
    ("Baseline sections absent from Sheet 3", "count(*) FILTER (has_baseline AND NOT has_third) FROM recon"), ("Sheet 1 baseline student rows", "sum(baseline) FILTER (has_baseline) FROM recon"),
    ("Baseline students matched in Sheet 2", "sum(matched_second) FROM recon"), ("Baseline students missing from Sheet 2", "sum(missing_second) FROM recon"),
    ("Unmatched/extra Sheet 2 rows in baseline sections", "sum(extra_second) FROM recon"), ("Baseline students matched in Sheet 3", "sum(matched_third) FROM recon"),
    ("Baseline students missing from Sheet 3", "sum(missing_third) FROM recon"), ("Unmatched/extra Sheet 3 rows in baseline sections", "sum(extra_third) FROM recon"),
    ("Baseline students matched in both later sheets", "sum(matched_both) FROM recon"), ("Baseline students missing in at least one later sheet", "sum(missing_either) FROM recon"),
    ("No-baseline Sheet 2 student rows", "sum(second) FILTER (NOT has_baseline) FROM recon"), ("No-baseline Sheet 3 student rows", "sum(third) FILTER (NOT has_baseline) FROM recon"),
    ("No-baseline students matched between Sheets 2 and 3", "sum(matched_later) FROM recon"), ("No-baseline rows only in Sheet 2", "sum(only_second) FROM recon"),
    ("No-baseline rows only in Sheet 3", "sum(only_third) FROM recon"), ("Student exception rows", "count(*) FROM lacking"), ("Unmatched later-record rows", "count(*) FROM later"),
    ("Duplicate-name groups", f"count(*) FROM (SELECT 1 FROM st GROUP BY period, {_KEYS}, student HAVING count(*) > 1)"),
    ("Matches needing review", "count(*) FROM review WHERE status = 'Needs review'"), ("Data-quality issues", "count(*) FROM faults WHERE issue_type <> ''"),
]

_YES = "CASE WHEN {0} THEN 'Yes' WHEN NOT {0} THEN 'No' END"
_SHEET = ", ".join(f'{sql} AS "{name}"' for name, sql in (
    ("District", "district"), ("School", "school"), ("Section", "section"),
    ("Comparison Basis", "CASE WHEN has_baseline THEN 'Sheet 1 baseline' ELSE 'Sheets 2-3 comparison (no Sheet 1 baseline)' END"),
    ("Sheet 1 Section Available", _YES.format("has_baseline")), ("Sheet 2 Section Available", _YES.format("has_second")), ("Sheet 3 Section Available", _YES.format("has_third")),
    ("Sheet 1 Student Count", "baseline"), ("Sheet 2 Student Count", "second"), ("Sheet 3 Student Count", "third"), ("Sheet 1-2 Matched", "matched_second"),
    ("Baseline Students Missing from Sheet 2", "missing_second"), ("Unmatched/Extra Sheet 2 Rows", "extra_second"), ("Sheet 2 Exact Baseline Roster", _YES.format("exact_roster_second")),
    ("Sheet 1-3 Matched", "matched_third"), ("Baseline Students Missing from Sheet 3", "missing_third"), ("Unmatched/Extra Sheet 3 Rows", "extra_third"),
    ("Sheet 3 Exact Baseline Roster", _YES.format("exact_roster_third")), ("Baseline Students Matched in Both Later Sheets", "matched_both"),
    ("Baseline Students Missing in At Least One Later Sheet", "missing_either"), ("Sheet 2-3 Matched (No Baseline)", "matched_later"), ("Only in Sheet 2 (No Baseline)", "only_second"),
    ("Only in Sheet 3 (No Baseline)", "only_third"), ("Sheet 2-3 Exact Roster Match (No Baseline)", _YES.format("exact_roster_later")),
))

ORACLES: dict[str, str] = {
    "tracking_matches": oracle(f"SELECT {_KEYS}, l AS left_row, r AS right_row, score, method FROM m WHERE lp = 1 AND rp = 2", "periods", recursive=True, more=_P),
    "section_reconciliation_matched": oracle("SELECT * FROM recon", "periods", recursive=True, more=_P),
    "student_exceptions_matched": oracle(f"""
SELECT * FROM lacking UNION ALL
SELECT s.{_KEYS.replace(", ", ", s.")}, s.period, s.student, s.row_number, NULL, NULL, NULL, NULL, NULL, NULL, 'Not in Sheet 1, extra in Sheet ' || s.period
FROM st s ANTI JOIN m ON m.district = s.district AND m.school = s.school AND m.section = s.section AND m.rp = s.period AND m.r = s.row_number WHERE s.period > 1""", "periods", recursive=True, more=_P),
    "overview_metrics_matched": oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS metric, CAST({'count(*)' if c == 'sections' else f'coalesce(sum({c}), 0)'} AS BIGINT) AS value FROM recon"
            for c in ("sections", "baseline", "second", "third", "matched_second", "missing_second", "extra_second", "matched_third", "missing_third", "extra_third", "matched_both",
                      "missing_either", "matched_later", "only_second", "only_third")
        ) + "".join(
            f" UNION ALL SELECT '{c}', count(*) FILTER ({c}) FROM recon"
            for c in ("has_baseline", "has_second", "has_third", "exact_roster_second", "exact_roster_third", "exact_roster_later")
        ), "periods", recursive=True, more=_P),
    "period_faults": oracle("SELECT period, row_number, section_key, issue_type, issue_type IN ('', 'Blank student name') AS kept FROM faults", "sheet_rows", more=FAULTS),
    "data_issues": oracle("""
SELECT 'Data issue' AS status, issue_type, district, school, CASE WHEN issue_type = 'Blank student name' THEN section_key ELSE section END AS section, name AS period,
       CAST(row_number AS VARCHAR) AS source_row, CASE issue_type WHEN 'Incomplete location data' THEN 'District=' || district || '; School=' || school || '; Section=' || section
         WHEN 'Unexpected grade' THEN grade WHEN 'Invalid section' THEN section ELSE '' END AS original_value, CASE WHEN issue_type = 'Unexpected grade' THEN CAST(wanted AS VARCHAR) ELSE '' END AS candidate_value,
       CAST(NULL AS DOUBLE) AS similarity_score, CAST(NULL AS DOUBLE) AS second_best_score,
       CASE issue_type WHEN 'Incomplete location data' THEN 'District, school, and section are required for strict district-school-section matching.'
         WHEN 'Unexpected grade' THEN 'The row was excluded because its grade did not match the period.' WHEN 'Invalid section' THEN 'The section must contain exactly one letter.'
         ELSE 'The section is treated as present, but this row is not counted as a student.' END AS reason
FROM faults JOIN (VALUES (1, '1st Semester 3rd Grade'), (2, '2nd Semester 3rd Grade'), (3, '4th Grade')) AS t(period, name) USING (period) WHERE issue_type <> ''""", "sheet_rows", more=FAULTS),
    "comparison_plan": oracle(f"""
SELECT {_KEYS}, CASE WHEN lp = 1 THEN 'Sheet 1 baseline' ELSE 'Sheets 2-3 comparison (no Sheet 1 baseline)' END AS mode, lp AS left_period, rp AS right_period FROM plan""",
        "tracked", recursive=True, more=_T),
    "section_sheet": oracle(f"SELECT {_SHEET} FROM recon", "tracked", recursive=True, more=_T),
    "unmatched_candidates": oracle(f'SELECT {_KEYS}, lp AS left_period, rp AS right_period, side, "row", student, other, score, second FROM left_over', "tracked", recursive=True, more=_T),
    "later_rows": oracle("SELECT * FROM later", "tracked", recursive=True, more=_T),
    "match_review": oracle("SELECT * FROM review", "tracked", recursive=True, more=_T),
    "tracking_overview": oracle(
        " UNION ALL ".join(f"SELECT {k} AS place, '{name}' AS metric, CAST(coalesce(v, 0) AS BIGINT) AS value FROM (SELECT {sql.replace(' FROM', ' AS v FROM', 1)})" for k, (name, sql) in enumerate(_METRICS)),
        "sheet_rows", recursive=True, more=f"{_T},{FAULTS}"),
    "scan_counts": oracle("""
SELECT sheet, count(*) AS rows_examined, count(*) FILTER (district = '') AS incomplete_rows, count(*) FILTER (district <> '' AND length(section) > 1) AS invalid_section_rows,
       count(DISTINCT district || '/' || school) FILTER (looked AND school LIKE '%q' AND fits) AS fuzzy_names, 0 AS ambiguous_names,
       count(DISTINCT district || '/' || school) FILTER (looked AND school LIKE '%q' AND NOT fits) AS unmatched_names, count(*) FILTER (looked AND school LIKE '%q' AND fits) AS fuzzy_matched_rows
FROM (SELECT *, district <> '' AND length(section) = 1 AS looked, 2.0 * (length(school) - 1) / (2 * length(school) - 1) * 100.0 >= 92 AS fits FROM scan) GROUP BY sheet""", "sheet_rows", more="""
scan AS (SELECT 'sheet' || period AS sheet, district, CASE WHEN row_number % 37 = 0 THEN school || 'q' ELSE school END AS school, section FROM sheet_rows)"""),
    "missing_by_sheet": oracle("""
SELECT sheet, district, school, section FROM (SELECT DISTINCT sheet FROM scan), (SELECT DISTINCT district, school, upper(section) AS section FROM roster)
EXCEPT SELECT sheet, district, own, upper(section) FROM scan WHERE district <> '' AND length(section) = 1 AND (school = own OR fits)""", "sheet_rows", more="""
scan AS (
  SELECT 'sheet' || period AS sheet, district, school AS own, CASE WHEN row_number % 37 = 0 THEN school || 'q' ELSE school END AS school, section,
         2.0 * length(school) / (2 * length(school) + 1) * 100.0 >= 92 AS fits FROM sheet_rows)"""),
    "missing_entries": oracle("""
SELECT CASE row_number % 3 WHEN 0 THEN '3. Sinif 1. Donem' WHEN 1 THEN '4 SINIF' ELSE '3 sinif 2' END AS sheet, row_number, district,
       array_to_string(list_transform(string_split(school, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' Ilkokulu' AS school,
       replace(upper(replace(section, 'i', 'İ')), 'ı', 'I') AS section, CASE row_number % 3 WHEN 1 THEN '4' ELSE '3' END AS grade, CASE row_number % 3 WHEN 0 THEN '1' WHEN 1 THEN '' ELSE '2' END AS term, school AS keyword
FROM roster WHERE row_number % 5 <> 0 AND row_number % 7 <> 0""", "roster"),
    "text_evidence": oracle("""
SELECT row_number, CASE WHEN row_number % 3 = 0 THEN '3,4' ELSE '4' END AS grades, CASE WHEN row_number % 3 = 0 THEN '2' ELSE '' END AS terms, upper(section) AS sections,
       CASE WHEN row_number % 3 = 0 THEN 'not,puan' ELSE 'puan' END AS grade_headings FROM roster""", "roster"),
    "sheet_lookup": "SELECT CASE n_nationkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN n_name || '?' ELSE n_name END AS sheet, CASE WHEN n_nationkey % 3 <> 1 THEN n_name END AS found FROM nation",
    "roster_problems": oracle("""
SELECT row_number, concat_ws('; ', CASE WHEN row_number % 50 = 0 THEN 'v1 is not in ''District / School'' format' END, CASE WHEN row_number % 40 = 0 THEN 'v3 student name is blank' END,
       CASE WHEN row_number % 60 = 0 THEN 'v2 section is blank' END) AS problem FROM roster""", "roster"),
}
