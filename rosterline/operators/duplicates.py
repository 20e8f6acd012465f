"""Duplicate groups in sheets and the roster, and which roster students each sheet holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.operators.relational import numbered


def sheet_duplicates(rows: DataFrame, keys: list[str], exact: list[str], sheet: str = "sheet", row: str = "row") -> DataFrame:
    """Groups of rows of a sheet with equal normalised ``keys``: Exact if all ``exact`` cells agree too, else Normalized.

    Rows with a blank key are left out. Group numbers follow the first row of each group in its sheet.
    """
    filled = F.lit(True)
    for k in keys:
        filled = filled & (F.coalesce(F.col(k), F.lit("")) != "")
    groups = rows.where(filled).groupBy(sheet, *keys).agg(
        F.count("*").alias("occurrences"), F.count_distinct(F.struct(*exact)).alias("forms"), F.min(row).alias("first_row"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.col(row))), lambda x: x.cast("string")), ", ").alias("rows"),
    ).where("occurrences > 1")
    block = F.floor(F.col("first_row") / F.lit(100_000))
    groups = numbered(groups.withColumn("__block", block), ["__block"], ["first_row"], "__n", within=[sheet])
    return groups.withColumns({
        "duplicate_type": F.when(F.col("forms") == 1, "Exact").otherwise("Normalized"),
        "duplicate_group": F.format_string("S%s-D%04d", F.col(sheet).cast("string"), "__n"),
    }).drop("forms", "__block", "__n")


def repeated_names(rows: DataFrame, keys: list[str], name: str, raw: str, row: str) -> DataFrame:
    """Names that occur more than once under the keys, with their spellings and rows in order."""
    got = rows.groupBy(*keys, name).agg(
        F.count("*").alias("n"),
        F.array_join(F.array_sort(F.collect_set(raw)), " | ").alias("spellings"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.col(row))), lambda x: x.cast("string")), ", ").alias("rows"),
    )
    return got.where("n > 1")


INVALID, REPEATED, ABSENT, SEVERAL = "Invalid ERC data", "Duplicate ERC key — see Sheet 8", "Not Present", "Duplicate — see Sheet 8"


def availability(roster: DataFrame, reports: DataFrame, sheets: list[str], keys: list[str], valid: str = "valid") -> DataFrame:
    """A row per roster row and a column per sheet: the student's name in the report, or why there is none.

    Precedence: invalid roster row, repeated roster key, absent, found once, found several times. All
    sheets come from one pass over the reports.
    """
    found = reports.groupBy(*keys).pivot("sheet", sheets).agg(F.count(F.lit(1)).alias("n"), F.min("student_raw").alias("name"))
    sizes = roster.where(valid).groupBy(*keys).agg(F.count("*").alias("__size"))
    rows = roster.join(sizes, keys, "left").join(found, keys, "left")
    def cell(s: str):
        n = F.coalesce(f"`{s}_n`", F.lit(0))
        return (
            F.when(~F.col(valid), INVALID).when(F.col("__size") > 1, REPEATED).when(n == 0, ABSENT)
            .when(n == 1, F.col(f"`{s}_name`")).otherwise(SEVERAL).alias(s)
        )

    return rows.select("row_number", *keys, *[cell(s) for s in sheets])


def availability_duplicates(roster: DataFrame, reports: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated roster keys, then repeated keys per report sheet, numbered by one counter."""
    own = roster.groupBy(*keys).agg(F.count("*").alias("n"), F.min("row_number").alias("first_row")).where("n > 1")
    own = own.select(F.lit("").alias("sheet"), *keys, "n", "first_row", F.lit("Duplicate in ERC Full List").alias("duplicate_type"), F.lit(0).alias("part"))
    other = reports.groupBy("sheet", *keys).agg(F.count("*").alias("n"), F.min("row_number").alias("first_row")).where("n > 1")
    other = other.select("sheet", *keys, "n", "first_row", F.lit("Multiple rows in report sheet").alias("duplicate_type"), F.lit(1).alias("part"))
    both = own.unionByName(other)
    both = numbered(both.withColumn("__block", F.floor(F.col("first_row") / F.lit(100_000))), ["part", "sheet", "__block"], ["first_row", *keys], "number")
    name = F.when(F.col("part") == 0, F.format_string("ERC-%04d", "number")).otherwise(F.format_string("REPORT-%04d", "number"))
    return both.withColumn("group_id", name).drop("part", "number", "__block")
