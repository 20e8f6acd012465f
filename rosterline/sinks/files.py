"""Logs, payloads and files per group."""

from __future__ import annotations

import csv
import json
import os
import re
import tempfile
from collections.abc import Callable, Iterable
from typing import IO

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs that no file name may hold.
REFUSED = r'[<>:"/\\|?*\x00-\x1f]+'


def _whole(path: str, write: Callable[[IO[str]], None], encoding: str = "utf-8") -> None:
    """Writes a file beside its place and puts it there in one step."""
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    try:
        with open(handle, "w", encoding=encoding, newline="") as f:
            write(f)
        os.replace(temporary, path)
    finally:
        if os.path.exists(temporary):
            os.unlink(temporary)


def write_log(df: DataFrame, path: str) -> int:
    """Rows as one CSV file that spreadsheets open as UTF-8; returns how many there were. Rows come a partition at a time."""
    count = 0

    def write(f: IO[str]) -> None:
        nonlocal count
        rows = csv.writer(f)
        rows.writerow(df.columns)
        for row in df.toLocalIterator():
            rows.writerow(["" if v is None else v for v in row])
            count += 1

    _whole(path, write, "utf-8-sig")
    return count


def write_payload(summary: dict, tables: dict[str, DataFrame], path: str) -> None:
    """One JSON object: the summary's fields, then every table as a list of its rows, a partition at a time."""

    def write(f: IO[str]) -> None:
        f.write("{")
        for k, (name, value) in enumerate(summary.items()):
            f.write(f"{', ' if k else ''}{json.dumps(name)}: {json.dumps(value, ensure_ascii=False, default=str)}")
        for k, (name, df) in enumerate(tables.items(), len(summary)):
            f.write(f"{', ' if k else ''}{json.dumps(name)}: [")
            for n, row in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
                f.write((", " if n else "") + row[0])
            f.write("]")
        f.write("}\n")

    _whole(path, write)


def safe_part(text: str) -> str:
    """A piece of a file name: what file systems refuse and white space as one underscore each, "unknown" where nothing is left."""
    return re.sub(r"_+", "_", re.sub(REFUSED + r"|\s+", "_", text.strip())).strip("_. ") or "unknown"


def file_part(column: Column | str) -> Column:
    """``safe_part`` of a column, built in."""
    text = F.regexp_replace(F.trim(F.coalesce(column, F.lit(""))), REFUSED + r"|\s+", "_")
    text = F.regexp_replace(F.regexp_replace(text, "_+", "_"), r"^[_. ]+|[_. ]+$", "")
    return F.when(text == "", "unknown").otherwise(text)


def group_name(parts: Iterable[str]) -> Column:
    """Name of the file that a row's group goes to."""
    return F.concat_ws("_", *map(file_part, parts))


def write_groups(df: DataFrame, folder: str, parts: list[str], format: str = "parquet") -> None:
    """A folder of files per group of rows, named by the group's parts; written by the executors, all groups at once."""
    df.withColumn("group", group_name(parts)).write.partitionBy("group").format(format).mode("errorifexists").save(folder)
