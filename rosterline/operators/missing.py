"""Missing sections: what period sheets hold against what a treatment list requires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.normalize import normalised
from rosterline.operators.discovery import keyword, searchable


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def section_of(c: Column) -> Column:
    """The one letter of a section in Turkish capitals, null where it is not one letter."""
    letter = F.upper(F.translate(c, "ıi", "Iİ"))
    return F.when((F.char_length(c) == 1) & F.rlike(letter, F.lit(r"^\p{L}$")), letter)


def scanned(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """``rows`` (sheet, district, school, section) with ``state``: blank, incomplete, invalid section, or the status of the location.

    ``resolved`` (district, school, r_district, r_school, status) has one row per location. What is not blank, complete
    and of one letter is not looked up. ``section_key`` and the resolved location come along.
    """
    empty = [_text(c) == "" for c in ("district", "school", "section")]
    letter = section_of(_text("section"))
    early = F.when(empty[0] & empty[1] & empty[2], "blank").when(empty[0] | empty[1] | empty[2], "incomplete").when(letter.isNull(), "invalid section")
    found = resolved.select("district", "school", "r_district", "r_school", F.col("status").alias("__status"))
    got = rows.withColumns({"state": early, "section_key": letter}).join(found, ["district", "school"], "left")
    open_row = F.col("state").isNull()
    return got.withColumns({
        "r_district": F.when(open_row, F.col("r_district")), "r_school": F.when(open_row, F.col("r_school")), "state": F.coalesce("state", "__status", F.lit("unmatched")),
    }).drop("__status")


def scan_counts(rows: DataFrame, sheet: str = "sheet") -> DataFrame:
    """Per sheet: rows examined, incomplete ones, ones without a valid section, different locations by status, rows found by similarity."""
    name = F.struct("district", "school")
    is_ = lambda s: F.col("state") == s
    return rows.groupBy(sheet).agg(
        F.count("*").alias("rows_examined"), F.count_if(is_("incomplete")).alias("incomplete_rows"), F.count_if(is_("invalid section")).alias("invalid_section_rows"),
        *[F.count_distinct(F.when(is_(s), name)).alias(f"{s}_names") for s in ("fuzzy", "ambiguous", "unmatched")], F.count_if(is_("fuzzy")).alias("fuzzy_matched_rows"),
    )


def missing_sections(required: DataFrame, rows: DataFrame, sheets: DataFrame) -> DataFrame:
    """(sheet, district, school, section) that ``required`` names and the scanned ``rows`` of the sheet lack."""
    here = rows.where("state IN ('exact', 'fuzzy')").select("sheet", F.col("r_district").alias("district"), F.col("r_school").alias("school"), F.col("section_key").alias("section")).distinct()
    every = sheets.select("sheet").distinct().join(required.select("district", "school", "section").distinct(), F.lit(True))
    return every.join(here, ["sheet", "district", "school", "section"], "left_anti")


def missing_entries(report: DataFrame) -> DataFrame:
    """Entries of a report of missing sections (sheet, row_number, district, school, section): with grade, term and keyword.

    Grade and term are read from the sheet's title. Rows that lack a cell go, as do those whose section, behind its last
    slash, is not one character.
    """
    title = normalised("sheet", "search")
    titles = report.select("sheet").distinct().withColumn("__title", title)
    grade = F.regexp_extract("__title", r"\b([234])\s*sinif\b", 1)
    term = F.regexp_extract("__title", r"\b([12])\s*d", 1)
    term = F.when((grade == "3") & (term == ""), F.regexp_extract("__title", r"\b([12])\b", 1)).otherwise(term)
    titles = titles.select("sheet", grade.alias("grade"), term.alias("term"))
    section = F.trim(F.element_at(F.split(F.upper(F.translate(F.trim("section"), "iı", "İI")), "/"), -1))
    whole = F.lit(True)
    for c in ("district", "school", "section"):
        whole = whole & (F.coalesce(F.col(c), F.lit("")) != "")
    rows = report.where(whole).withColumn("section", section).where(F.char_length("section") == 1).join(titles, "sheet")
    keys = rows.select("school").distinct().withColumn("keyword", keyword(normalised("school", "search")))
    return rows.join(keys, "school").select("sheet", "row_number", F.trim("district").alias("district"), F.trim("school").alias("school"), "section", "grade", "term", "keyword")


# Headings that a text with grades has.
HEADINGS = ("turkce", "matematik", "fen bilimleri", "hayat bilgisi", "ders", "not", "puan", "davranis", "karne", "ortalama")


def text_evidence(text: Column, key: Column | None = None) -> Column:
    """grades, terms, sections and grade headings that a text names; ``key`` is its search key, worked out for ASCII text where none is given."""
    key = searchable(text) if key is None else F.concat(F.lit(" "), key, F.lit(" "))
    all_of = lambda c, pattern: F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
    turkish = F.upper(F.translate(text, "iı", "İI"))
    grades = F.concat(all_of(key, r"\b([234])\s*sinif\b"), all_of(text, r"(?<!\d)([234])\s*[/\-]\s*[A-Za-zÇĞİÖŞÜçğıöşü]"))
    sections = all_of(turkish, r"(?<!\d)[234]\s*[/\-]\s*([A-ZÇĞİÖŞÜ])(?![A-ZÇĞİÖŞÜ])")
    headings = F.filter(F.array(*map(F.lit, HEADINGS)), lambda h: F.contains(key, F.concat(F.lit(" "), h, F.lit(" "))))
    ordered = lambda c: F.array_sort(F.array_distinct(c))
    return F.struct(
        ordered(grades).alias("grades"), ordered(all_of(key, r"\b([12])\s*donem\b")).alias("terms"), ordered(sections).alias("sections"), headings.alias("grade_headings"),
    )


def sheet_lookup(wanted: DataFrame, sheets: DataFrame, name: str = "sheet") -> DataFrame:
    """(name, found) of every distinct name: the sheet of that very name, else the only one of the same normalised name, else null."""
    every = wanted.select(name).distinct().withColumn("__key", normalised(name, "duplicate"))
    there = sheets.select(F.col(name).alias("found")).distinct().withColumn("__key", normalised("found", "duplicate"))
    same = there.select(F.col("found").alias(name), F.col("found").alias("__same"))
    one = there.groupBy("__key").agg(F.count("*").alias("__n"), F.min("found").alias("__one")).where("__n = 1").drop("__n")
    return every.join(same, name, "left").join(one, "__key", "left").select(name, F.coalesce("__same", "__one").alias("found"))


def roster_problems(rows: DataFrame) -> DataFrame:
    """Roster rows (v1, v2, v3) with place, section, student and the text of what is wrong with them; wholly blank rows go.

    An invalid row stays, without a usable key.
    """
    from rosterline.operators.relational import section_part, split_location

    rows = rows.where((_text("v1") != "") | (_text("v2") != "") | (_text("v3") != ""))
    rows = split_location(rows, "v1").withColumn("section", section_part(F.coalesce("v2", F.lit(""))))
    problem = F.concat_ws(
        "; ", F.when(F.col("district").isNull(), "v1 is not in 'District / School' format"), F.when(_text("v3") == "", "v3 student name is blank"),
        F.when(F.col("section") == "", "v2 section is blank"),
    )
    return rows.withColumns({"student": _text("v3"), "problem": problem})


def report_index(rows: DataFrame, keys: list[str], section: str = "section") -> DataFrame:
    """Rows of report sheets that name a roster section, with ``eligible``: false where a key is blank, so that they cannot be looked up."""
    there = F.lit(True)
    for k in keys:
        there = there & (_text(k) != "")
    return rows.where(_text(section) != "").withColumn("eligible", there)
