"""DuckDB SQL of the queries, written on its own: the same tables, no shared logic but the derived tables."""

from __future__ import annotations

from rosterline.plans import linkage_oracles, tracking_oracles
from rosterline.plans.fixtures import oracle, ratio_sql

_ENTRY = """entry AS (
  SELECT row_number, CASE WHEN row_number % 50 = 0 THEN school ELSE district || ' / ' || school END AS v1,
         '4-' || upper(section) AS v2, CASE WHEN row_number % 40 = 0 THEN ' ' ELSE student END AS v3,
         CASE WHEN row_number % 50 <> 0 THEN district END AS district, CASE WHEN row_number % 50 <> 0 THEN school END AS school
  FROM roster)"""

_GRADES = """g AS (
  SELECT l_orderkey, substr(p_brand, 7, 1) AS course, CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) AS grade,
         printf('%04d%012d%04d', l_linenumber, l_partkey, CAST(floor(l_quantity) AS INTEGER)) AS o
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_REPORTS = """reports AS (
  SELECT 'sheet' || period AS sheet, district, school, student, upper(student) AS student_raw, row_number FROM periods
  UNION ALL
  SELECT 'sheet' || period, district, school, student, upper(student), row_number + 5000000 FROM periods WHERE row_number % 13 = 0)"""

_FLAGS = """flags AS (
  SELECT district, school, section, student, k, max(CASE WHEN period = 1 THEN 1 ELSE 0 END) AS p1, max(CASE WHEN period = 2 THEN 1 ELSE 0 END) AS p2,
         max(CASE WHEN period = 3 THEN 1 ELSE 0 END) AS p3, min(CASE WHEN period = 1 THEN row_number END) AS row_number
  FROM (SELECT *, row_number() OVER (PARTITION BY period, district, school, section, student ORDER BY row_number) AS k FROM periods) GROUP BY 1, 2, 3, 4, 5)"""

_RECONCILED = f"""{_FLAGS},
recon AS (
  SELECT district, school, section, sum(p1) AS baseline, sum(p2) AS second, sum(p3) AS third, sum(p1 * p2) AS matched_second, sum(p1 * p3) AS matched_third,
         sum(p1 * p2 * p3) AS matched_both, sum((1 - p1) * p2) AS extra_second, sum((1 - p1) * p3) AS extra_third
  FROM flags GROUP BY 1, 2, 3 HAVING sum(p1) > 0),
recon2 AS (
  SELECT *, baseline - matched_second AS missing_second, baseline - matched_third AS missing_third, baseline - matched_both AS missing_either,
         second > 0 AND baseline = matched_second AND extra_second = 0 AS exact_roster_second,
         third > 0 AND baseline = matched_third AND extra_third = 0 AS exact_roster_third FROM recon)"""

_METRICS = ["sections", "baseline", "second", "third", "matched_second", "matched_third", "matched_both", "extra_second", "extra_third", "missing_second", "missing_third", "missing_either"]

_KEYWORDS = """words AS (
  SELECT DISTINCT keyword FROM (SELECT split_part(lower(n_name), '_', 1) AS keyword FROM nation
  UNION ALL SELECT unnest(['the', 'of the', 'und der', 'de la'])))"""

_HITS = f"""{_KEYWORDS},
hits AS (
  SELECT conv_id, turn, keyword FROM conversations JOIN words
    ON contains(' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ', ' ' || keyword || ' '))"""

_SCORED = """both_rows AS (SELECT *, row_number % 1000000 AS k FROM period_repeats WHERE row_number < 1000000 OR row_number % 2 = 0),
old_rows AS (
  SELECT row_number AS "row", district, school, section, student,
         CASE WHEN k % 5 = 0 THEN '3' WHEN k % 23 = 0 THEN '=A1' WHEN k % 7 = 0 THEN '2' END AS score, k % 11 AS c1
  FROM both_rows WHERE period = 1),
new_rows AS (
  SELECT row_number AS new_row, district, school, section, student,
         CASE WHEN k % 35 = 0 THEN '3' WHEN k % 10 = 0 THEN '9' END AS there, CASE WHEN k % 12 = 0 THEN -1 ELSE k % 11 END AS n1
  FROM both_rows WHERE period = 3)"""

ORACLES: dict[str, str] = linkage_oracles.ORACLES | tracking_oracles.ORACLES | {
    "roster_split_location": oracle("SELECT row_number, district, school FROM entry", "roster", more=_ENTRY),
    "incomplete_counts": oracle(
        "SELECT count(*) FILTER (district IS NOT NULL AND trim(v3) <> '') AS usable, count(*) FILTER (trim(v3) = '') AS blank_students,"
        " count(*) FILTER (district IS NULL) AS invalid_places FROM entry", "roster", more=_ENTRY),
    "section_normalize": oracle("SELECT row_number, section FROM roster", "roster"),
    "normalize_ascii": "SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name_key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')) AS type_key FROM part",
    "forward_fill_context": """
SELECT conv_id, turn, last_value(nullif(trim(ctx), '') IGNORE NULLS) OVER w AS context, last_value(who IGNORE NULLS) OVER w AS speaker
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE '' END AS ctx, CASE WHEN turn % 3 = 0 THEN role END AS who FROM conversations)
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace("nullif(trim(ctx), '')", "CASE WHEN trim(ctx) <> '' THEN ctx END"),
    "missing_sections_anti": oracle("SELECT DISTINCT district, school, section FROM roster EXCEPT SELECT district, school, section FROM periods WHERE period = 3", "periods"),
    "required_section_check": oracle(
        "SELECT district, school, count(DISTINCT section) AS n_rows, count(DISTINCT section) AS n_parts FROM roster GROUP BY 1, 2 HAVING count(DISTINCT section) <> 5", "roster"),
    "union_periods": oracle("SELECT row_number, student, 'sheet' || period AS sheet FROM periods", "periods"),
    "append_merge": oracle("SELECT district, student FROM roster UNION ALL SELECT school, student FROM src WHERE src_row % 4 <> 1", "src"),
    "intersect_both_periods": oracle(
        "SELECT district, school, section, student FROM periods WHERE period = 2 INTERSECT SELECT district, school, section, student FROM periods WHERE period = 3", "periods"),
    "partition_check": "SELECT 0 AS src_row, 0 AS w, 0 AS m, 0 AS u WHERE false",
    "kth_occurrence_join": """
WITH n AS (SELECT user_id, event_id, event_type = 'click' AS u, row_number() OVER (PARTITION BY user_id, event_type = 'click' ORDER BY event_id) AS occurrence FROM events)
SELECT a.user_id, a.occurrence, a.event_id AS left_event_id, b.event_id AS right_event_id FROM n a JOIN n b USING (user_id, occurrence) WHERE a.u AND NOT b.u""",
    "page_ranges_islands": """
WITH r AS (SELECT l_orderkey, min(l_linenumber) AS a, max(l_linenumber) AS b FROM (
  SELECT DISTINCT l_orderkey, l_linenumber, l_linenumber - dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM lineitem WHERE l_linenumber <> 3) GROUP BY l_orderkey, k)
SELECT l_orderkey, string_agg(CASE WHEN a = b THEN 'row ' || a ELSE 'rows ' || a || '-' || b END, '; ' ORDER BY a) AS location FROM r GROUP BY 1""",
    "asof_preceding_anchor": """
WITH a AS (SELECT user_id, event_id AS a_id FROM events WHERE event_type = (SELECT min(event_type) FROM events))
SELECT e.user_id, e.event_id, (SELECT max(a_id) FROM a WHERE a.user_id = e.user_id AND a_id <= e.event_id) AS anchor,
       (SELECT min(a_id) FROM a WHERE a.user_id = e.user_id AND a_id > e.event_id) AS next_anchor FROM events e""",
    "merged_range_lookup": """
SELECT o_custkey % 50 AS sheet, o_orderkey AS "at", c_custkey FROM orders JOIN customer
  ON o_custkey % 50 = c_custkey % 50 AND o_orderkey BETWEEN c_custkey * 10 AND c_custkey * 10 + c_custkey % 90""",
    "course_pivot": f"""WITH {_GRADES}
SELECT l_orderkey, {", ".join(f"max_by(grade, o) FILTER (course = '{k}') AS course_{k}" for k in range(1, 10))} FROM g GROUP BY 1""",
    "coalesce_tables": f"""WITH {_GRADES}, o AS (SELECT l_orderkey, course, max_by(grade, o) AS grade FROM g GROUP BY 1, 2),
t AS (SELECT l_orderkey, course, CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE grade END AS grade FROM o WHERE l_orderkey % 3 <> 0),
x AS (SELECT l_orderkey, course, grade || 't' AS grade FROM o WHERE l_orderkey % 4 <> 0)
SELECT l_orderkey, course, coalesce(nullif(t.grade, ''), x.grade, t.grade) AS grade FROM t FULL JOIN x USING (l_orderkey, course)""",
    "mode_column_pair": """
SELECT l_suppkey, l_returnflag, l_linestatus, n FROM (
  SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(l_orderkey * 10 + l_linenumber)) AS r
  FROM lineitem GROUP BY 1, 2, 3) WHERE r = 1""",
    "majority_vote": """
SELECT l_partkey, vote, n FROM (SELECT l_partkey, l_linenumber AS vote, count(*) AS n, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_linenumber) AS r
  FROM lineitem GROUP BY 1, 2) WHERE r = 1""",
    "dup_exact_normalized": oracle("""
SELECT period AS sheet, district, school, section, student, n AS occurrences, CASE WHEN forms = 1 THEN 'Exact' ELSE 'Normalized' END AS duplicate_type,
       'S' || period || '-D' || lpad(CAST(row_number() OVER (PARTITION BY period ORDER BY first_row) AS VARCHAR), 4, '0') AS duplicate_group, "rows"
FROM (SELECT period, district, school, section, student, count(*) AS n, count(DISTINCT raw_section || '|' || raw_student) AS forms, min(row_number) AS first_row,
             string_agg(CAST(row_number AS VARCHAR), ', ' ORDER BY row_number) AS "rows" FROM period_repeats GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1)""", "period_repeats"),
    "dup_with_section": oracle("""
SELECT 'SC-' || lpad(CAST(g AS VARCHAR), CAST(greatest(4, length(CAST(g AS VARCHAR))) AS INTEGER), '0') AS group_id, n AS group_count, row_number, district, school, section, student
FROM roster_repeats JOIN (SELECT district, school, section, student, count(*) AS n, row_number() OVER (ORDER BY district, school, section, student) AS g FROM roster_repeats GROUP BY 1, 2, 3, 4 HAVING count(*) > 1)
USING (district, school, section, student)""", "roster_repeats"),
    "dup_without_section": oracle("""
SELECT 'RC-' || lpad(CAST(g AS VARCHAR), CAST(greatest(4, length(CAST(g AS VARCHAR))) AS INTEGER), '0') AS group_id, n AS group_count, row_number, district, school, student
FROM roster JOIN (SELECT district, school, student, count(*) AS n, row_number() OVER (ORDER BY district, school, student) AS g FROM roster GROUP BY 1, 2, 3 HAVING count(*) > 1)
USING (district, school, student)""", "roster"),
    "duplicate_names_listagg": oracle("""
SELECT period, district, school, student, count(*) AS n, string_agg(DISTINCT raw_student, ' | ' ORDER BY raw_student) AS spellings,
       string_agg(CAST(row_number AS VARCHAR), ', ' ORDER BY row_number) AS "rows" FROM period_repeats GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""", "period_repeats"),
    "availability_wide": oracle("""
SELECT row_number, district, school, student, """ + ", ".join(f"""CASE WHEN row_number % 17 = 0 THEN 'Invalid ERC data' WHEN size > 1 THEN 'Duplicate ERC key — see Sheet 8'
  WHEN coalesce(n{k}, 0) = 0 THEN 'Not Present' WHEN n{k} = 1 THEN m{k} ELSE 'Duplicate — see Sheet 8' END AS sheet{k}""" for k in (1, 2, 3)) + """
FROM roster LEFT JOIN (SELECT district, school, student, count(*) AS size FROM roster WHERE row_number % 17 <> 0 GROUP BY 1, 2, 3) USING (district, school, student)
LEFT JOIN (SELECT district, school, student, """ + ", ".join(f"count(*) FILTER (sheet = 'sheet{k}') AS n{k}, min(student_raw) FILTER (sheet = 'sheet{k}') AS m{k}" for k in (1, 2, 3)) + """
  FROM reports GROUP BY 1, 2, 3) USING (district, school, student)""", "periods", more=_REPORTS),
    "availability_duplicates": oracle("""
SELECT sheet, district, school, student, n, first_row, duplicate_type,
       (CASE WHEN part = 0 THEN 'ERC-' ELSE 'REPORT-' END) || lpad(CAST(row_number() OVER (ORDER BY part, sheet, first_row, district, school, student) AS VARCHAR), 4, '0') AS group_id
FROM (SELECT '' AS sheet, district, school, student, count(*) AS n, min(row_number) AS first_row, 'Duplicate in ERC Full List' AS duplicate_type, 0 AS part FROM roster GROUP BY ALL HAVING count(*) > 1
  UNION ALL SELECT sheet, district, school, student, count(*), min(row_number), 'Multiple rows in report sheet', 1 FROM reports GROUP BY 1, 2, 3, 4 HAVING count(*) > 1)""", "periods", more=_REPORTS),
    "keyword_hits": f"WITH {_HITS} SELECT conv_id, turn, keyword FROM hits",
    "keyword_locations": f"""WITH {_HITS}, r AS (SELECT conv_id, keyword, min(turn) AS a, max(turn) AS b FROM (
  SELECT conv_id, keyword, turn, turn - row_number() OVER (PARTITION BY conv_id, keyword ORDER BY turn) AS k FROM hits) GROUP BY conv_id, keyword, k)
SELECT conv_id, keyword, string_agg(CASE WHEN a = b THEN 'row ' || a ELSE 'rows ' || a || '-' || b END, '; ' ORDER BY a) AS location FROM r GROUP BY 1, 2""",
    "path_only_hits": """
WITH w AS (SELECT unnest(['com', 'fr', 'page', 'html']) AS keyword),
p AS (SELECT page_id, ' ' || trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) || ' ' AS u, ' ' || trim(regexp_replace(lower(html), '[^a-z0-9]+', ' ', 'g')) || ' ' AS h FROM pages)
SELECT page_id, keyword FROM p, w WHERE contains(u, ' ' || keyword || ' ') AND NOT contains(h, ' ' || keyword || ' ')""",
    "content_hash_duplicates": """
WITH d AS (SELECT doc_id, sha256(text) AS sha256, n_chars % 7 <> 0 AS ok FROM documents)
SELECT doc_id, sha256, CASE WHEN first <> doc_id THEN first END AS duplicate_of FROM (SELECT *, min(doc_id) FILTER (ok) OVER (PARTITION BY sha256) AS first FROM d)""",
    "manifest_counts": "SELECT lang AS status, count(*) AS instances, count(DISTINCT sha256(text)) AS unique_hashes FROM documents GROUP BY ROLLUP (lang)",
    "ratio_pairs": f"""WITH RECURSIVE p AS (
  SELECT lower(n_name) AS a, lower(r_name) AS b FROM nation, region UNION SELECT lower(x.n_name), reverse(lower(y.n_name)) FROM nation x, nation y),
pairs AS (SELECT a, b FROM p WHERE a <> b), {ratio_sql()}
SELECT p.a, p.b, CASE WHEN p.a = p.b THEN 100.0 ELSE s.score END AS score FROM p LEFT JOIN scores s ON s.a = p.a AND s.b = p.b""",
    "ratio_token_sort": oracle("""
SELECT t.src_row, t.student, t.r_student, CASE WHEN t.student = t.r_student THEN 100.0 ELSE greatest(x.score, coalesce(y.score, 100.0)) END AS score
FROM t LEFT JOIN scores x ON x.a = student AND x.b = r_student LEFT JOIN scores y ON y.a = s1 AND y.b = s2""", "src", recursive=True, more=f"""
t AS (SELECT src_row, s.student, r.student AS r_student, array_to_string(list_sort(string_split(s.student, ' ')), ' ') AS s1, array_to_string(list_sort(string_split(r.student, ' ')), ' ') AS s2
  FROM src s JOIN roster r ON src_row = row_number),
pairs AS (SELECT DISTINCT a, b FROM (SELECT student AS a, r_student AS b FROM t UNION ALL SELECT s1, s2 FROM t) WHERE a <> b), {ratio_sql()}"""),
    "cohort_summary": oracle("""
SELECT *, original_red_records - red_to_green - red_to_yellow AS not_promoted_by_rules, 100.0 * red_to_green / original_red_records AS red_to_green_percent,
       100.0 * (red_to_green + red_to_yellow) / original_red_records AS red_reduction_percent FROM (
  SELECT sheet, count(*) AS original_red_records, count(*) FILTER (up AND decision LIKE 'Green%') AS red_to_green, count(*) FILTER (up AND decision LIKE 'Yellow%') AS red_to_yellow,
         count(*) FILTER (pattern <> '') AS flagged, count(*) FILTER (baseline_is_red AND NOT up) AS still_red,
         count(*) FILTER (NOT baseline_is_red) AS baseline_now_nonred, count(*) FILTER (baseline_red_reason = 'red_location') AS red_location_now
  FROM (SELECT *, baseline_red_reason = 'red_name' AND adjusted > baseline AS up FROM audit) GROUP BY ROLLUP (sheet))""", "audit"),
    "red_improvement": oracle("""
SELECT *, baseline_red - red_to_green - red_to_yellow AS red_remaining, 100.0 * red_to_green / baseline_red AS red_to_green_percent,
       100.0 * (red_to_green + red_to_yellow) / baseline_red AS red_reduction_percent, 100.0 * name_red_to_green / red_name AS name_red_to_green_percent FROM (
  SELECT sheet, count(*) AS records, count(*) FILTER (red) AS baseline_red, count(*) FILTER (why = 'red_name') AS red_name, count(*) FILTER (why = 'red_location') AS red_location,
         count(*) FILTER (red AND up AND decision LIKE 'Green%') AS red_to_green, count(*) FILTER (red AND up AND decision LIKE 'Yellow%') AS red_to_yellow,
         count(*) FILTER (red AND adjusted > baseline) AS red_score_increases, count(*) FILTER (why = 'red_name' AND up AND decision LIKE 'Green%') AS name_red_to_green,
         count(*) FILTER (why = 'red_location' AND up AND decision LIKE 'Green%') AS location_red_to_green
  FROM (SELECT *, baseline_is_red AS red, baseline_red_reason AS why, adjusted > baseline AND adjusted > 0.9 AS up FROM audit) GROUP BY ROLLUP (sheet))""", "audit"),
    "audit_counters": oracle("""
SELECT count(*) AS records, count(*) FILTER (baseline <= 0.9) AS baseline_at_or_below_90, count(*) FILTER (adjusted > baseline) AS score_increases, 0 AS score_decreases,
       count(*) FILTER (crossed) AS crossed_90, count(*) FILTER (crossed AND decision LIKE 'Green%') AS promoted_green, count(*) FILTER (crossed AND decision LIKE 'Yellow%') AS promoted_yellow,
       count(*) FILTER (pattern = '') AS unrelated_records, 0 AS unrelated_changed, count(*) FILTER (adjusted = baseline) AS unchanged_scores, count(*) FILTER (pattern <> '') AS flagged,
       count(*) FILTER (decision = 'Review only') AS review_only, count(DISTINCT person) FILTER (pattern <> '') AS flagged_pairs,
       count(DISTINCT person) FILTER (crossed AND decision LIKE 'Green%') AS promoted_green_pairs, count(DISTINCT person) FILTER (adjusted > baseline) AS increased_pairs
FROM (SELECT *, adjusted > baseline AND baseline <= 0.9 AND adjusted > 0.9 AS crossed FROM audit)""", "audit"),
    "pattern_histogram": oracle("SELECT pattern, count(*) AS pairs FROM audit WHERE pattern <> '' GROUP BY 1", "audit"),
    "transfer_scores": oracle("""
SELECT o."row", CASE WHEN o.score LIKE '=%' THEN 'formula_scores' WHEN n_old > 1 THEN 'ambiguous_old' WHEN n_new IS NULL THEN 'no_exact_match' WHEN n_new > 1 THEN 'ambiguous_new'
    WHEN c1 <> n1 THEN 'changed_context' WHEN there = o.score THEN 'already_present' WHEN there IS NOT NULL THEN 'target_conflicts' ELSE 'transferred' END AS outcome,
  CASE WHEN n_new = 1 THEN new_row END AS new_row, o.score
FROM (SELECT *, count(*) OVER (PARTITION BY district, school, section, student) AS n_old FROM old_rows) o
LEFT JOIN (SELECT district, school, section, student, count(*) AS n_new, min(new_row) AS new_row, min(there) AS there, min(n1) AS n1 FROM new_rows GROUP BY 1, 2, 3, 4) n USING (district, school, section, student)
WHERE o.score IS NOT NULL""", "period_repeats", more=_SCORED),
    "apply_corrections": oracle("""
SELECT s.row_number AS "row", coalesce(t.name, s.student) AS student, t.name IS NOT NULL AS corrected FROM roster s LEFT JOIN (
  SELECT target, min(name) AS name FROM (
    SELECT name, coalesce((SELECT min(r.row_number) FROM roster r WHERE r.district = i.district AND r.school = i.school AND r.section = i.section AND r.student = i.student HAVING count(*) = 1),
      (SELECT min(r.row_number) FROM roster r WHERE r.district = i.district AND r.school = i.school AND substr(r.student, 1, 9) = i.short HAVING count(*) = 1)) AS target FROM instr i)
  WHERE target IS NOT NULL GROUP BY target HAVING count(*) = 1) t ON target = s.row_number""", "roster", more="""
instr AS (SELECT district, school, section, CASE WHEN row_number % 2 = 0 THEN student ELSE '?' END AS student, substr(student, 1, 9) AS short, 'new ' || student AS name
  FROM roster WHERE row_number % 3 = 0 AND row_number % 5 <> 1 AND row_number % 9 <> 0)"""),
    "tracking_exact": oracle("""
SELECT a.district, a.school, a.section, a.student, a.row_number AS left_row_number, b.row_number AS right_row_number
FROM n a JOIN n b USING (district, school, section, student, k) WHERE a.period = 1 AND b.period = 2""", "periods",
        more="n AS (SELECT *, row_number() OVER (PARTITION BY period, district, school, section, student ORDER BY row_number) AS k FROM periods)"),
    "section_reconciliation": oracle("SELECT * FROM recon2", "periods", more=_RECONCILED),
    "student_exceptions": oracle("""
SELECT district, school, section, student, row_number, CASE WHEN p2 + p3 = 0 THEN 'Missing from Sheets 2 and 3' WHEN p2 = 0 THEN 'Missing from Sheet 2' ELSE 'Missing from Sheet 3' END AS exception_type
FROM flags WHERE p1 = 1 AND p2 * p3 = 0""", "periods", more=_FLAGS),
    "overview_metrics": oracle(
        " UNION ALL ".join(
            [f"SELECT '{m}' AS metric, {'count(*)' if m == 'sections' else f'sum({m})'} AS value FROM recon2" for m in _METRICS]
            + [f"SELECT '{m}', count(*) FILTER ({m}) FROM recon2" for m in ("exact_roster_second", "exact_roster_third")]
        ), "periods", more=_RECONCILED),
}
