"""Roster, source and period tables derived from the driver's tables; one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ROSTER = """
base AS (
  SELECT c_custkey, md5(cast(c_custkey AS varchar(20))) AS h,
         lower(r_name) AS district, lower(replace(n_name, '_', ' ')) AS school,
         lower(substr(c_mktsegment, 1, 1)) AS section
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
named AS (
  SELECT c_custkey + 2 AS row_number, district, school, section,
         translate(substr(h, 1, 6),  '0123456789abcdef', 'bcdfghjkaeioulmn') || ' ' ||
         translate(substr(h, 7, 6),  '0123456789abcdef', 'bcdfghjkaeioulmn') || ' ' ||
         translate(substr(h, 13, 6), '0123456789abcdef', 'bcdfghjkaeioulmn') || ' ' ||
         translate(substr(h, 19, 6), '0123456789abcdef', 'bcdfghjkaeioulmn') AS student
  FROM base),
roster AS (
  SELECT row_number, district, school, section, student FROM named
  UNION ALL
  SELECT row_number + 1000000 AS row_number, district, school, 'y' AS section, student FROM named WHERE row_number % 30 = 0)"""

SRC = """
src AS (
  SELECT row_number AS src_row, district,
         CASE WHEN row_number % 7 = 6 THEN school || 'q zz' ELSE school END AS school,
         CASE WHEN row_number % 5 = 4 THEN 'z' ELSE section END AS section,
         CASE row_number % 6
           WHEN 0 THEN student
           WHEN 1 THEN substr(student, 1, 1) || substr(student, 7)
           WHEN 2 THEN substr(student, 1, 20)
           WHEN 3 THEN substr(student, 1, 13)
           WHEN 4 THEN substr(student, 1, 10) || 'x' || substr(student, 12)
           ELSE substr(student, 8) || ' ' || substr(student, 1, 6) END AS student
  FROM roster WHERE row_number < 1000000 AND (row_number % 3 = 0 OR row_number % 4 = 1))"""

PERIODS = """
periods AS (
  SELECT 1 AS period, row_number, district, school, section, student FROM roster WHERE row_number < 1000000 AND row_number % 11 <> 0
  UNION ALL
  SELECT 2 AS period, row_number, district, school, section,
         CASE WHEN row_number % 9 = 0 THEN substr(student, 1, 10) || 'x' || substr(student, 12) ELSE student END AS student
  FROM roster WHERE row_number < 1000000 AND row_number % 10 <> 0
  UNION ALL
  SELECT 3 AS period, row_number, district, school, section, student FROM roster WHERE row_number < 1000000 AND row_number % 7 <> 0)"""

def ratio_sql(name: str = "") -> str:
    """Common tables that give ``<name>scores`` (a, b, score): the ratio of the distinct texts of ``<name>pairs`` (a, b), on a scale of 100.

    For the SQL side only. Runs of equal letters on every diagonal are laid out once per pair; every step takes the
    longest run, cut to its segment, of each segment that is left, the earliest of equals.
    """
    return f"""
{name}numbered AS (SELECT a, b, row_number() OVER () AS pid FROM {name}pairs),
{name}cells AS (
  SELECT pid, x.i, y.j, x.i - y.j AS d
  FROM (SELECT pid, unnest(range(1, length(a) + 1)) AS i, unnest(string_split(a, '')) AS c FROM {name}numbered) x
  JOIN (SELECT pid, unnest(range(1, length(b) + 1)) AS j, unnest(string_split(b, '')) AS c FROM {name}numbered) y USING (pid, c)),
{name}runs AS (
  SELECT pid, i, j, count(*) OVER (PARTITION BY pid, d, g ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS r
  FROM (SELECT *, i - row_number() OVER (PARTITION BY pid, d ORDER BY i) AS g FROM {name}cells)),
{name}seg(pid, alo, ahi, blo, bhi, k) AS (
  SELECT pid, 1, length(a) + 1, 1, length(b) + 1, 0 FROM {name}numbered
  UNION ALL
  SELECT pid, unnest([alo, i + m]), unnest([i, ahi]), unnest([blo, j + m]), unnest([j, bhi]), unnest([m, 0]) FROM (
    SELECT pid, alo, ahi, blo, bhi, i, j, m FROM (
      SELECT s.pid, alo, ahi, blo, bhi, i, j, least(r, ahi - i, bhi - j) AS m,
             row_number() OVER (PARTITION BY s.pid, alo, ahi, blo, bhi ORDER BY least(r, ahi - i, bhi - j) DESC, i, j) AS rn
      FROM {name}seg s JOIN {name}runs t ON t.pid = s.pid AND i >= alo AND i < ahi AND j >= blo AND j < bhi) WHERE rn = 1)),
{name}scores AS (
  SELECT a, b, 2.0 * sum(k) / (length(a) + length(b)) * 100.0 AS score FROM {name}seg JOIN {name}numbered USING (pid) GROUP BY a, b)"""


#: Rows of the roster and of the periods that stand in their table twice, some written otherwise the second time.
REPEATS = """
roster_repeats AS (
  SELECT row_number, district, school, section, student FROM roster
  UNION ALL
  SELECT row_number + 2000000, district, school, section, student FROM roster WHERE row_number % 20 = 0),
period_repeats AS (
  SELECT period, row_number, district, school, section, student, section AS raw_section, student AS raw_student FROM periods
  UNION ALL
  SELECT period, row_number + 5000000, district, school, section, student, CASE WHEN row_number % 26 = 0 THEN upper(section) ELSE section END, CASE WHEN row_number % 39 = 0 THEN upper(student) ELSE student END
  FROM periods WHERE row_number % 13 = 0)"""

#: Periods with sections that the first lacks, blank names and faulty rows.
TRACKED = """
tracked AS (
  SELECT period, row_number, district, school, section, CASE WHEN row_number % 97 = 0 THEN '' ELSE student END AS student FROM periods
  WHERE NOT (period = 1 AND section = 'b' AND length(school) % 2 = 0)),
sheet_rows AS (
  SELECT period, row_number, CASE WHEN row_number % 31 = 0 THEN '' ELSE district END AS district, school,
         CASE WHEN row_number % 29 = 0 THEN '7' WHEN period = 3 THEN '4,0' ELSE '3' END AS grade,
         CASE WHEN row_number % 23 = 0 THEN 'ab' WHEN row_number % 2 = 0 THEN upper(section) ELSE section END AS section, student FROM tracked)"""

#: Audited pairs: scores as fractions, a pattern for some, and a rise only with a pattern.
AUDIT = """
audit0 AS (
  SELECT o_orderkey AS k, o_orderstatus AS sheet, o_custkey AS person, cast((o_orderkey % 101) / 100.0 AS double) AS baseline,
         CASE o_orderkey % 5 WHEN 0 THEN 'Initial abbreviation' WHEN 1 THEN 'Trailing omission' ELSE '' END AS pattern FROM orders),
audit1 AS (
  SELECT *, CASE WHEN pattern <> '' AND k % 2 = 0 AND baseline < 0.97 THEN cast(0.97 AS double) ELSE baseline END AS adjusted, baseline <= 0.9 AND k % 3 <> 0 AS baseline_is_red FROM audit0),
audit AS (
  SELECT *, CASE WHEN NOT baseline_is_red THEN '' WHEN k % 4 = 0 THEN 'red_location' ELSE 'red_name' END AS baseline_red_reason,
         CASE WHEN adjusted > baseline AND k % 7 < 4 THEN 'Green + review' WHEN adjusted > baseline THEN 'Yellow + review' WHEN pattern <> '' THEN 'Review only' ELSE 'Unchanged' END AS decision FROM audit1)"""

_WITH = {
    "roster": (ROSTER,), "src": (ROSTER, SRC), "periods": (ROSTER, PERIODS), "roster_repeats": (ROSTER, PERIODS, REPEATS), "period_repeats": (ROSTER, PERIODS, REPEATS), "audit": (AUDIT,), "tracked": (ROSTER, PERIODS, TRACKED), "sheet_rows": (ROSTER, PERIODS, TRACKED),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of ``_WITH``."""
    text = ",".join(_WITH[name])
    tables = {}
    for t in ("customer", "nation", "region", "orders"):
        placed = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
        if placed != text:
            tables[t], text = load(spark, sf_dir, t), placed
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **tables)


def oracle(query: str, *names: str, recursive: bool = False, more: str = "") -> str:
    """``query`` for DuckDB over the derived tables it names; ``more`` holds further common tables."""
    parts = list(dict.fromkeys(part for n in names for part in _WITH[n]))
    if more:
        parts.append(more)
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(parts)}\n{query}" if parts else query
