"""DuckDB SQL of the queries that compare names: every pair is scored, nothing is ruled out before."""

from __future__ import annotations

import re

from rosterline.plans.fixtures import oracle, ratio_sql

RESOLVED = f"""
loc AS (SELECT district AS r_district, school AS r_school, min(row_number) AS first_row FROM roster GROUP BY ALL),
want AS (SELECT DISTINCT district, school FROM src),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT district AS a, r_district AS b FROM want, loc UNION ALL SELECT school, r_school FROM want, loc) WHERE a <> b),
{ratio_sql()},
sim AS (
  SELECT w.*, l.*, CASE WHEN district = r_district THEN 100.0 ELSE d.score END AS ds, CASE WHEN school = r_school THEN 100.0 ELSE s.score END AS ss
  FROM want w CROSS JOIN loc l LEFT JOIN scores d ON d.a = district AND d.b = r_district LEFT JOIN scores s ON s.a = school AND s.b = r_school),
ranked AS (
  SELECT *, (ds >= 95 AND ss >= 95) AS accepted, row_number() OVER (PARTITION BY district, school ORDER BY (ds >= 95 AND ss >= 95) DESC,
    (district = r_district AND school = r_school) DESC, least(ds, ss) DESC, (ds + ss) / 2.0 DESC, ss DESC, ds DESC, first_row) AS rn FROM sim),
resolved AS (SELECT * FROM ranked WHERE rn = 1)"""

#: Every roster row of the resolved location of every source row with the score of the names.
SCORED = f"""{RESOLVED},
cand AS (
  SELECT s.src_row, s.section, s.student, r.section AS r_section, r.student AS r_student, r.row_number AS r_row
  FROM src s JOIN resolved v USING (district, school) JOIN roster r ON r.district = v.r_district AND r.school = v.r_school WHERE v.accepted),
npairs AS (SELECT DISTINCT student AS a, r_student AS b FROM cand WHERE student <> r_student),
{ratio_sql("n")},
scored AS (
  SELECT c.*, CASE WHEN student = r_student THEN 100.0 ELSE x.score END AS score, section <> '' AND section = r_section AS same
  FROM cand c LEFT JOIN nscores x ON x.a = student AND x.b = r_student)"""

CLASSES = f"""{SCORED},
best AS (
  SELECT *, row_number() OVER (PARTITION BY src_row ORDER BY score DESC, same DESC, r_row) AS rn,
         row_number() OVER (PARTITION BY src_row, same ORDER BY score DESC, r_row) AS own_rn, count(*) FILTER (score > 90) OVER (PARTITION BY src_row) AS hits FROM scored),
naming AS (
  SELECT s.src_row, v.*, coalesce(b.hits, 0) AS n_over, b.r_student, b.r_section, b.r_row, b.score, b.same, o.r_student AS own_student, o.score AS own_score,
         CASE WHEN NOT accepted THEN 'red_location' WHEN coalesce(b.hits, 0) = 0 THEN 'red_name' WHEN b.hits > 1 THEN 'orange' WHEN b.same THEN 'green' ELSE 'yellow' END AS status
  FROM src s JOIN resolved v USING (district, school) LEFT JOIN best b ON b.src_row = s.src_row AND b.rn = 1 LEFT JOIN best o ON o.src_row = s.src_row AND o.same AND o.own_rn = 1),
cls AS (
  SELECT src_row, status, CASE WHEN accepted THEN n_over ELSE 0 END AS n_candidates, r_district, r_school,
         CASE WHEN status IN ('green', 'yellow') THEN r_student END AS matched_student, CASE WHEN status IN ('green', 'yellow') THEN r_section END AS matched_section,
         CASE WHEN status IN ('green', 'yellow') THEN r_row END AS matched_row, CASE WHEN status IN ('green', 'yellow') THEN score END AS score,
         CASE WHEN status = 'red_name' THEN r_student END AS best_student, CASE WHEN status = 'red_name' THEN score END AS best_score, CASE WHEN status = 'red_name' THEN r_section END AS best_section,
         CASE WHEN status = 'red_name' THEN own_student END AS best_in_section, CASE WHEN status = 'red_name' THEN own_score END AS best_in_section_score,
         ds AS district_score, ss AS school_score,
         CASE WHEN accepted THEN '' ELSE 'Location not accepted: ' || concat_ws('; ', CASE WHEN ds < 95 THEN printf('district similarity %.2f%% is below 95.00%%', ds) END,
              CASE WHEN ss < 95 THEN printf('school similarity %.2f%% is below 95.00%%', ss) END) || '.' END AS reason
  FROM naming)"""


def evidence_sql(pairs: str) -> str:
    """Common tables that give ``evidence`` of the distinct name pairs (a, b) of ``pairs``, by counting parts."""
    return f"""
ev0 AS (
  SELECT a, b, CASE WHEN len(string_split(a, ' ')) <= len(string_split(b, ' ')) THEN string_split(a, ' ') ELSE string_split(b, ' ') END AS s,
         CASE WHEN len(string_split(a, ' ')) <= len(string_split(b, ' ')) THEN string_split(b, ' ') ELSE string_split(a, ' ') END AS l
  FROM (SELECT DISTINCT a, b FROM {pairs}) WHERE a <> b AND regexp_full_match(a || b, '[a-zA-Z ]+')),
ev1 AS (SELECT a, b, unnest(range(1, len(s) + 1)) AS at, unnest(s) AS p, unnest(l[1:len(s)]) AS q FROM ev0),
tpairs AS (SELECT DISTINCT p AS a, q AS b FROM ev1 WHERE p <> q AND length(p) > 1 AND length(q) > 1),
{ratio_sql("t")},
ev2 AS (
  SELECT e.*, least(length(p), length(q)) > 1 AS whole, least(length(p), length(q)) = 1 AND p <> q AS short_one, CASE WHEN p = q THEN 100.0 ELSE t.score END AS sim
  FROM ev1 e LEFT JOIN tscores t ON t.a = p AND t.b = q),
ev3 AS (
  SELECT a, b, count(*) FILTER (short_one AND p[1] = q[1]) AS initials, count(*) FILTER (short_one AND p[1] <> q[1]) AS clashes,
         count(*) FILTER (whole AND p <> q) AS fuzzy, count(*) FILTER (whole) AS n_whole, count(*) FILTER (length(p) = 1 AND p = q) AS letters,
         least(count(DISTINCT p) FILTER (whole), count(DISTINCT q) FILTER (whole)) AS anchors, sum(sim) FILTER (whole) AS total, min(sim) FILTER (whole) AS lowest
  FROM ev2 GROUP BY a, b),
ev4 AS (
  SELECT *, len(l) - len(s) AS omitted, l[len(s) + 1:] AS tail, 100.0 - 3.0 * (initials + len(l) - len(s) + fuzzy) AS rule
  FROM ev0 JOIN ev3 USING (a, b)),
evidence AS (
  SELECT a, b, initials, omitted, anchors, fuzzy, list_has_any(tail, l[1:len(s)]) AS repeated,
         CASE WHEN initials > 0 AND omitted > 0 THEN 'Initials and trailing omission' WHEN initials > 0 THEN 'Initial abbreviation' ELSE 'Trailing omission' END AS pattern,
         CASE WHEN NOT ((initials > 0 AND len(s) < 3) OR (omitted > 0 AND (len(s) < 3 OR anchors < 3)) OR omitted > 2 OR list_has_any(tail, l[1:len(s)])
                OR len(list_filter(tail, lambda w: length(w) = 1)) > 0 OR (omitted = 0 AND (anchors < 2 OR length(s[-1]) = 1 OR length(l[-1]) = 1))
                OR initials > 2 OR 2 * initials > len(s) OR letters > 0 OR rule <= 90) THEN rule END AS rule_score
  FROM ev4
  WHERE clashes = 0 AND initials + omitted > 0 AND CASE WHEN initials > 0 THEN n_whole > 0 AND total / n_whole >= 90 ELSE coalesce(lowest, 100) >= 90 END)"""


ASSESSED = f"""{CLASSES},
epairs AS (SELECT student AS a, r_student AS b FROM cand),
{evidence_sql("epairs")},
adj AS (
  SELECT c.*, e.pattern, e.rule_score, greatest(c.score, coalesce(e.rule_score, c.score)) AS proposed,
         greatest(c.score, coalesce(e.rule_score, c.score)) > 90 OR (e.pattern IS NOT NULL AND e.anchors >= 2 AND NOT e.repeated) AS plausible
  FROM scored c LEFT JOIN evidence e ON e.a = student AND e.b = r_student),
ord AS (
  SELECT *, row_number() OVER w AS rn, nth_value(proposed, 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS next, max(proposed) OVER (PARTITION BY src_row) AS top,
         count(*) FILTER (plausible) OVER (PARTITION BY src_row) AS n_plausible, count(*) FILTER (proposed > 90) OVER (PARTITION BY src_row) AS n_over
  FROM adj WINDOW w AS (PARTITION BY src_row ORDER BY proposed DESC, r_row DESC)),
judged AS (
  SELECT *, n_plausible - CAST(plausible AS INTEGER) AS rivals, rule_score IS NULL OR n_plausible - CAST(plausible AS INTEGER) > 0
         OR proposed - coalesce(CASE WHEN rn = 1 THEN next ELSE top END, 0) < 5 OR section = '' OR n_over <> 1 OR proposed <= 90 AS blocked FROM ord WHERE pattern IS NOT NULL),
assessed AS (
  SELECT src_row, r_row, r_student, r_section, pattern, rule_score, score AS baseline, CASE WHEN blocked THEN score ELSE proposed END AS adjusted, rivals,
         CASE WHEN blocked THEN 'Review only' WHEN section = r_section THEN 'Green + review' ELSE 'Yellow + review' END AS decision FROM judged),
promoted AS (
  SELECT src_row, count(*) AS n_patterned, count(*) FILTER (decision LIKE '% + review') AS n, max(decision) FILTER (decision LIKE '% + review') AS decision,
         max(r_student) FILTER (decision LIKE '% + review') AS r_student FROM assessed GROUP BY src_row),
outcome AS (
  SELECT c.src_row, c.status AS baseline_status, CASE WHEN c.status = 'red_name' AND p.n = 1 THEN p.decision WHEN c.status NOT LIKE 'red%' THEN 'Baseline already nonred'
         WHEN c.status = 'red_name' AND p.n_patterned > 0 THEN 'Review only' ELSE 'Unchanged red' END AS decision,
         c.status = 'red_name' AND coalesce(p.n_patterned, 0) > 0 AS review_required, CASE WHEN c.status = 'red_name' AND p.n = 1 THEN p.r_student END AS promoted_student
  FROM cls c LEFT JOIN promoted p USING (src_row))"""

_SORT = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"


def _better(a: str, b: str, plain: str, ordered: str) -> str:
    """The better of the scores of two texts as they are and with words sorted, joined as ``plain`` and ``ordered``."""
    return f"CASE WHEN {a} = {b} THEN 100.0 ELSE greatest({plain}.score, coalesce({ordered}.score, 100.0)) END"


def _scores_of(a: str, b: str, scores: str, plain: str, ordered: str) -> str:
    return f"LEFT JOIN {scores} {plain} ON {plain}.a = {a} AND {plain}.b = {b} LEFT JOIN {scores} {ordered} ON {ordered}.a = {_SORT.format(a)} AND {ordered}.b = {_SORT.format(b)}"


def _both_forms(a: str, b: str, table: str) -> str:
    return f"SELECT {a} AS a, {b} AS b FROM {table} UNION ALL SELECT {_SORT.format(a)}, {_SORT.format(b)} FROM {table}"


LEGACY = f"""
places AS (SELECT DISTINCT district, school, section FROM roster),
open AS (SELECT DISTINCT district, school, section FROM src ANTI JOIN places USING (district, school, section)),
near AS (SELECT o.*, p.district AS n_district, p.school AS n_school FROM open o JOIN places p USING (section)),
pairs AS (SELECT DISTINCT a, b FROM ({_both_forms("district", "n_district", "near")} UNION ALL {_both_forms("school", "n_school", "near")}) WHERE a <> b),
{ratio_sql()},
weighed AS (
  SELECT n.*, {_better("district", "n_district", "x", "y")} AS ds, {_better("school", "n_school", "z", "w")} AS ss
  FROM near n {_scores_of("district", "n_district", "scores", "x", "y")} {_scores_of("school", "n_school", "scores", "z", "w")}),
nearest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY district, school, section ORDER BY ds * 0.35 + ss * 0.65 DESC, n_district, n_school) AS rn
  FROM weighed WHERE ds >= 90 AND ss >= 90) WHERE rn = 1),
placed AS (
  SELECT s.*, e.row_number IS NOT NULL AS exact, coalesce(p.district, n.n_district) AS r_district, coalesce(p.school, n.n_school) AS r_school
  FROM src s LEFT JOIN (SELECT district, school, section, student, min(row_number) AS row_number FROM roster GROUP BY 1, 2, 3, 4) e USING (district, school, section, student)
  LEFT JOIN places p USING (district, school, section) LEFT JOIN nearest n USING (district, school, section)),
block AS (
  SELECT p.src_row, p.student, r.student AS r_student, r.row_number AS r_row FROM placed p JOIN roster r ON r.district = r_district AND r.school = r_school AND r.section = p.section WHERE NOT exact),
npairs AS (SELECT DISTINCT a, b FROM ({_both_forms("student", "r_student", "block")}) WHERE a <> b),
{ratio_sql("n")},
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src_row ORDER BY score DESC, r_row) AS rn FROM (
    SELECT b.*, {_better("student", "r_student", "x", "y")} AS score FROM block b {_scores_of("student", "r_student", "nscores", "x", "y")}) WHERE score >= 88) WHERE rn = 1)"""

TWO_LEVEL = f"""
places AS (SELECT DISTINCT district, school FROM roster),
want AS (SELECT DISTINCT district, school FROM src),
rest AS (SELECT * FROM want ANTI JOIN places USING (district, school)),
pairs AS (SELECT DISTINCT r.school AS a, p.school AS b FROM rest r JOIN places p USING (district)),
{ratio_sql()},
scored AS (
  SELECT r.*, p.school AS r_school, s.score, row_number() OVER w AS rn, lead(s.score) OVER w AS next
  FROM rest r JOIN places p USING (district) JOIN scores s ON s.a = r.school AND s.b = p.school WINDOW w AS (PARTITION BY r.district, r.school ORDER BY s.score DESC, p.school DESC))"""

ORACLES: dict[str, str] = {
    "resolve_location": oracle(
        "SELECT district, school, accepted, r_district, r_school, ds AS district_score, ss AS school_score FROM resolved", "src", recursive=True, more=RESOLVED),
    "classify_students": oracle("SELECT * FROM cls", "src", recursive=True, more=CLASSES),
    "status_rollup": oracle("""
SELECT *, red_location + red_name AS red FROM (
  SELECT sheet, count(*) AS total, count(*) FILTER (status = 'green') AS green, count(*) FILTER (status = 'yellow') AS yellow, count(*) FILTER (status = 'orange') AS orange,
         count(*) FILTER (status = 'red_location') AS red_location, count(*) FILTER (status = 'red_name') AS red_name, count(*) FILTER (lacking) AS incomplete
  FROM (SELECT c.status, CAST(src_row % 3 AS VARCHAR) AS sheet, s.section = '' AS lacking FROM cls c JOIN bare s USING (src_row)) GROUP BY ROLLUP (sheet))""",
        "src", recursive=True, more="bare AS (SELECT src_row, district, school, CASE WHEN src_row % 8 = 0 THEN '' ELSE section END AS section, student FROM src)," + re.sub(r"\b(FROM|JOIN) src\b", r"\1 bare", CLASSES)),
    "best_by_section": oracle(
        "SELECT src_row, best_student, best_score, best_in_section, best_in_section_score FROM cls WHERE status = 'red_name'", "src", recursive=True, more=CLASSES),
    "multiple_candidates": oracle("""
SELECT * FROM (SELECT src_row, row_number() OVER (PARTITION BY src_row ORDER BY score DESC, same DESC, r_row) AS candidate_rank, count(*) OVER (PARTITION BY src_row) AS n_candidates,
  r_row, r_section, r_student, score FROM scored WHERE score > 90) WHERE n_candidates > 1""", "src", recursive=True, more=SCORED),
    "match_report": oracle("""
SELECT s.district AS "District", s.school AS "School Name", s.section AS "Section", s.student AS "Student Name", matched_student AS "Matched ERC Student Name", score / 100.0 AS "Name Similarity",
       matched_section AS "ERC Section", CASE WHEN matched_row IS NOT NULL THEN r_school END AS "ERC School", CASE WHEN matched_row IS NOT NULL THEN r_district END AS "ERC District"
FROM src s JOIN cls USING (src_row)""", "src", recursive=True, more=CLASSES),
    "mismatch_report": oracle("""
SELECT 'Sheet ' || (src_row % 3 + 1) AS "Source Sheet", s.district AS "Source District", s.school AS "Source School", s.section AS "Source Section", s.student AS "Source Student Name",
       r_district AS "ERC District", district_score / 100.0 AS "District Similarity", r_school AS "ERC School", school_score / 100.0 AS "School Similarity",
       best_in_section AS "Best Candidate in Source Section", best_in_section_score / 100.0 AS "Source-Section Similarity",
       CASE WHEN best_in_section IS NOT NULL THEN s.section END AS "Source-Section ERC Section", best_student AS "Best Candidate Across All Sections",
       best_score / 100.0 AS "All-Sections Similarity", best_section AS "All-Sections ERC Section", reason AS "Reason Not Matched"
FROM src s JOIN cls USING (src_row) WHERE status LIKE 'red%'""", "src", recursive=True, more=CLASSES),
    "mismatch_cohort": oracle("""
SELECT 'Sheet ' || (src_row % 3 + 1) AS sheet, s.district, s.student, reason FROM src s JOIN cls USING (src_row) WHERE status LIKE 'red%'""", "src", recursive=True, more=CLASSES),
    "candidates_report": oracle("""
SELECT 'Sheet ' || (c.src_row % 3 + 1) AS "Source Sheet", s.district AS "Source District", s.school AS "Source School", s.section AS "Source Section", s.student AS "Source Student Name",
       c.r_student AS "Matched ERC Student Name", c.score / 100.0 AS "Name Similarity", c.r_section AS "ERC Section", r.school AS "ERC School", r.district AS "ERC District"
FROM (SELECT *, count(*) OVER (PARTITION BY src_row) AS n FROM scored WHERE score > 90) c JOIN src s USING (src_row) JOIN roster r ON r.row_number = c.r_row WHERE n > 1""",
        "src", recursive=True, more=SCORED),
    "baseline_red": oracle("""
SELECT src_row, CASE WHEN status = 'red_location' THEN 'red_location' WHEN target IS NOT NULL AND coalesce(x.score, 100) > 90 AND r_district = m_district AND r_school = m_school THEN ''
                     WHEN status = 'red_name' THEN 'red_name' ELSE '' END AS reason
FROM cls JOIN mapped USING (src_row) LEFT JOIN mscores x ON x.a = name AND x.b = target""", "src", recursive=True, more=f"""{CLASSES},
mapped AS (
  SELECT s.src_row, s.student AS name, r.district AS m_district, CASE WHEN r.row_number % 4 = 0 THEN 'nowhere' ELSE r.school END AS m_school,
         CASE WHEN r.row_number % 4 <> 0 AND (SELECT count(*) FROM roster o WHERE o.district = r.district AND o.school = r.school AND o.section = r.section AND o.student = r.student) = 1
              THEN r.student END AS target FROM src s JOIN roster r ON r.row_number = s.src_row),
mpairs AS (SELECT DISTINCT name AS a, target AS b FROM mapped WHERE name <> target),
{ratio_sql("m")}"""),
    "legacy_report": oracle('SELECT district AS "District", school AS "School Name", section AS "Section", student AS "Student Name" FROM src', "src"),
    "legacy_classify": oracle("""
SELECT p.src_row, CASE WHEN exact THEN 'exact' WHEN h.r_student IS NOT NULL THEN 'fuzzy' ELSE 'unmatched' END AS status,
       CASE WHEN exact THEN p.student ELSE h.r_student END AS matched_student, CASE WHEN exact THEN 100.0 ELSE h.score END AS score, r_district, r_school FROM placed p LEFT JOIN hits h USING (src_row)""",
        "src", recursive=True, more=LEGACY),
    "two_level_resolve": oracle("""
SELECT district, school, district AS r_district, school AS r_school, 100.0 AS d_score, 100.0 AS s_score, 'exact' AS status FROM want SEMI JOIN places USING (district, school)
UNION ALL
SELECT district, school, CASE WHEN out = 'fuzzy' THEN district END, CASE WHEN out = 'fuzzy' THEN r_school END, 100.0, score, out FROM (
  SELECT *, CASE WHEN score < 92 THEN 'unmatched' WHEN score - next < 3 THEN 'ambiguous' ELSE 'fuzzy' END AS out FROM scored WHERE rn = 1)""",
        "src", recursive=True, more=TWO_LEVEL),
    "name_evidence": oracle("""
SELECT src_row, coalesce(pattern, '') AS pattern, rule_score, coalesce(initials, 0) AS initials, coalesce(omitted, 0) AS omitted, coalesce(anchors, 0) AS anchors, coalesce(fuzzy, 0) AS fuzzy_parts
FROM own LEFT JOIN evidence USING (a, b)""", "src", recursive=True, more=f"""
own AS (SELECT src_row, s.student AS a, r.student AS b FROM src s JOIN roster r ON src_row = row_number), {evidence_sql("own")}"""),
    "assess_pairs": oracle("SELECT * FROM assessed", "src", recursive=True, more=ASSESSED),
    "promote_unmatched": oracle("SELECT * FROM outcome", "src", recursive=True, more=ASSESSED),
    "cohort_measures": oracle("""
SELECT *, original_red_records - red_to_green - red_to_yellow AS not_promoted_by_rules, 100.0 * red_to_green / original_red_records AS red_to_green_percent,
       100.0 * (red_to_green + red_to_yellow) / original_red_records AS red_reduction_percent FROM (
  SELECT sheet, count(*) AS original_red_records, count(*) FILTER (decision = 'Green + review') AS red_to_green, count(*) FILTER (decision = 'Yellow + review') AS red_to_yellow,
         count(*) FILTER (review_required) AS flagged, count(*) FILTER (decision NOT LIKE '% + review') AS still_red, 0 AS baseline_now_nonred,
         count(*) FILTER (baseline_status = 'red_location') AS red_location_now
  FROM (SELECT *, CAST(src_row % 3 AS VARCHAR) AS sheet FROM outcome WHERE baseline_status LIKE 'red%') GROUP BY ROLLUP (sheet))""",
        "src", recursive=True, more=ASSESSED),
}
