"""Table operations: locations, forward fill, islands, as-of and range lookups, set operations, pivots, votes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def split_location(df: DataFrame, column: str, district: str = "district", school: str = "school") -> DataFrame:
    """``district`` and ``school`` from "district / school" at the first slash; both null unless both are there."""
    parts = F.split(F.trim(F.col(column)), r"\s*/\s*", 2)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    usable = (F.coalesce(first, F.lit("")) != "") & (F.coalesce(second, F.lit("")) != "")
    return df.withColumns({district: F.when(usable, first), school: F.when(usable, second)})


def section_part(column: Column | str) -> Column:
    """Section of ASCII text without its grade in front and the word for section behind, in small letters."""
    text = F.regexp_replace(F.trim(column), r"^\d+\s*[-/]\s*", "")
    key = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return F.trim(F.regexp_replace(key, r"\s+(sube|subesi)$", ""))


def blank(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.trim(column), F.lit("")) == ""


def forward_fill(df: DataFrame, sheet: str, row: str, columns: list[str]) -> DataFrame:
    """Last value that is not blank of each column, per sheet in row order; fill before dropping any row."""
    before = Window.partitionBy(sheet).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.when(~blank(c), F.col(c)), ignorenulls=True).over(before) for c in columns})


def islands(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Runs of consecutive numbers per key: first, last and how they read, as "rows" of one row each."""
    place = Window.partitionBy(*keys).orderBy(number)
    rows = df.select(*keys, number).distinct().withColumn("__run", F.col(number) - F.row_number().over(place))
    found = rows.groupBy(*keys, "__run").agg(F.min(number).alias("first_no"), F.max(number).alias("last_no"))
    return found.drop("__run")


def range_text(found: DataFrame, keys: list[str], word: str = "row") -> DataFrame:
    """Islands of a key in one line: ``rows 2-3; row 7``."""
    one = F.concat(F.lit(f"{word} "), F.col("first_no").cast("string"))
    many = F.concat(F.lit(f"{word}s "), F.col("first_no").cast("string"), F.lit("-"), F.col("last_no").cast("string"))
    text = F.when(F.col("first_no") == F.col("last_no"), one).otherwise(many)
    parts = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first_no", text.alias("text")))).alias("parts"))
    return parts.select(*keys, F.array_join(F.transform("parts", lambda x: x["text"]), "; ").alias("location"))


def preceding_anchor(rows: DataFrame, group: str, order: str, is_anchor: Column) -> DataFrame:
    """anchor: order of the nearest anchor row at or before each row; next_anchor: of the next one after it."""
    back = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(group).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    mark = F.when(is_anchor, F.col(order))
    return rows.withColumns({"anchor": F.last(mark, ignorenulls=True).over(back), "next_anchor": F.first(mark, ignorenulls=True).over(ahead)})


def range_lookup(points: DataFrame, ranges: DataFrame, group: str, point: str, first: str, last: str, bucket: int = 64) -> DataFrame:
    """Points with the range of their group that holds them; an equi-join on buckets of ``bucket`` numbers, then the exact test."""
    width = F.lit(bucket)
    spread = ranges.withColumn("__b", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor(F.col(last) / width))))
    placed = points.withColumn("__b", F.floor(F.col(point) / width))
    found = placed.join(spread, [group, "__b"]).where(F.col(point).between(F.col(first), F.col(last)))
    return found.drop("__b")


def kth_occurrence_pairs(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Pairs the k-th row of a key on the left with the k-th on the right; ``left_<order>`` and ``right_<order>``."""
    def numbered(df: DataFrame, side: str) -> DataFrame:
        place = Window.partitionBy(*keys).orderBy(order)
        return df.select(*keys, F.col(order).alias(f"{side}_{order}"), F.row_number().over(place).alias("occurrence"))

    return numbered(left, "left").join(numbered(right, "right"), [*keys, "occurrence"])


def append_by_position(frames: list[DataFrame], keep_blank: bool = False) -> DataFrame:
    """Rows of all frames under the header of the first, by position; wholly blank rows go unless asked for."""
    if len(frames) < 2:
        raise ValueError("at least two tables are needed")
    first = frames[0]
    out = first
    for other in frames[1:]:
        if len(other.columns) != len(first.columns):
            raise ValueError("tables have different numbers of columns")
        out = out.union(other)
    if keep_blank:
        return out
    filled = F.lit(False)
    for c in out.columns:
        filled = filled | ~blank(F.col(c).cast("string"))
    return out.where(filled)


def union_sheets(frames: dict[str, DataFrame]) -> DataFrame:
    """All sheets with their name in ``sheet``."""
    parts = [df.withColumn("sheet", F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_combinations(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required key combinations that are not present."""
    return required.join(present.select(*keys).distinct(), keys, "left_anti")


def requirement_faults(required: DataFrame, keys: list[str], part: str, rows: int = 3) -> DataFrame:
    """Keys that do not have exactly ``rows`` rows with as many different parts."""
    got = required.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct(part).alias("n_parts"))
    return got.where((F.col("n_rows") != rows) | (F.col("n_parts") != rows))


def in_both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def partition_faults(whole: DataFrame, matched: DataFrame, unmatched: DataFrame, key: str) -> DataFrame:
    """Keys that are in both parts, in neither, or in a part only."""
    tagged = whole.select(key, F.lit(1).alias("w"), F.lit(0).alias("m"), F.lit(0).alias("u"))
    tagged = tagged.unionAll(matched.select(key, F.lit(0), F.lit(1), F.lit(0))).unionAll(unmatched.select(key, F.lit(0), F.lit(0), F.lit(1)))
    got = tagged.groupBy(key).agg(F.max("w").alias("w"), F.max("m").alias("m"), F.max("u").alias("u"))
    return got.where("w = 0 OR m + u <> 1")


def course_table(rows: DataFrame, keys: list[str], course: str, grade: str, order: str, courses: list[str]) -> DataFrame:
    """One row per key and a column per course: the last grade in order, blank or not. ``courses`` in their order of appearance."""
    last = F.max_by(grade, order)
    return rows.groupBy(*keys).pivot(course, courses).agg(last)


def courses_in_order(rows: DataFrame, course: str, order: str, limit: int = 1000) -> list[str]:
    """Courses by first appearance; one value per column of a report, so ``limit`` guards against a wrong column."""
    got = rows.groupBy(course).agg(F.min(order).alias("o")).orderBy("o", course).limit(limit + 1).collect()
    if len(got) > limit:
        raise ValueError(f"over {limit} courses")
    return [r[0] for r in got]


def coalesce_grades(table_grades: DataFrame, text_grades: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Outer merge of two readings; a table value that is not blank wins."""
    left = table_grades.select(*keys, F.col(value).alias("__t"))
    right = text_grades.select(*keys, F.col(value).alias("__x"))
    got = F.coalesce(F.when(~blank("__t"), F.col("__t")), F.col("__x"), F.col("__t"))
    return left.join(right, keys, "full").select(*keys, got.alias(value))


def most_common(df: DataFrame, keys: list[str], values: list[str], order: str | None = None) -> DataFrame:
    """Most frequent combination of values per key. Ties: first seen in ``order``, else the smallest."""
    agg = [F.count("*").alias("n")] + ([F.min(order).alias("__seen")] if order else [])
    counts = df.groupBy(*keys, *values).agg(*agg)
    ties = [F.col("__seen")] if order else []
    best = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("n"), *ties, *values)
    return counts.withColumn("__r", F.row_number().over(best)).where("__r = 1").select(*keys, *values, "n")


def duplicate_groups(df: DataFrame, keys: list[str], prefix: str, row: str) -> DataFrame:
    """Rows whose keys, none of them null, occur at least twice: group id by sorted key, count, row."""
    usable = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    sizes = usable.groupBy(*keys).agg(F.count("*").alias("group_count")).where("group_count > 1")
    ids = numbered(sizes, keys[:-1], keys, "__n").withColumn("group_id", F.format_string(f"{prefix}-%04d", "__n")).drop("__n")
    return usable.join(ids, keys).select("group_id", "group_count", row, *keys)


def numbered(df: DataFrame, lead: list[str], order: list[str], name: str, within: list[str] | None = None) -> DataFrame:
    """``df`` with its place, from 1, in the order of ``lead``, then ``order``, over all rows or per value of ``within``.

    Rows are counted inside each value of ``lead`` and set off by the sizes of the values before it, so that only one
    row per value of ``lead`` is ever put in order in one task.
    """
    within = within or []
    keys = [*within, *lead]
    before = Window.partitionBy(*within).orderBy(*lead).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__size")).withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    sizes = sizes.select("__before", *[F.col(c).alias(f"__lead_{c}") for c in keys])
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    got = df.withColumn(name, inside).join(sizes, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__lead_{c}")) for c in keys]))
    return got.withColumn(name, F.col(name) + F.col("__before")).drop("__before", *[f"__lead_{c}" for c in keys])
