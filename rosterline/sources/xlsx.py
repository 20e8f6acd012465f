"""XLSX workbooks as Spark tables, read with the standard library only.

One input partition per file and sheet. Rows come from streaming the sheet's XML; the dimension a sheet
claims is not trusted. Cells are text: numbers without a needless fraction, dates in ISO form by their
style, truth values as TRUE or FALSE, formulas as their stored value or, on request, as text.
"""

from __future__ import annotations

import datetime
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Number formats that are dates by definition; others are dates if their code holds a date letter.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def column_number(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference).group():
        n = 26 * n + ord(c) - 64
    return n


def column_letters(number: int) -> str:
    out = ""
    while number:
        number, rest = divmod(number - 1, 26)
        out = chr(65 + rest) + out
    return out


class Workbook:
    """Sheets of a workbook by name, in order."""

    def __init__(self, data: bytes | str):
        self.zip = zipfile.ZipFile(BytesIO(data) if isinstance(data, bytes) else data)
        links = ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in links}
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        self.epoch = datetime.datetime(1904, 1, 1) if any(p.get("date1904") in ("1", "true") for p in book.iter(f"{_MAIN}workbookPr")) else datetime.datetime(1899, 12, 30)
        self.paths = {}
        for s in book.iter(f"{_MAIN}sheet"):
            path = target[s.get(f"{_REL}id")]
            self.paths[s.get("name")] = path.lstrip("/") if path.startswith("/") else f"xl/{path}"
        names = set(self.zip.namelist())
        self.strings = self._strings() if "xl/sharedStrings.xml" in names else []
        self.dates = self._dates() if "xl/styles.xml" in names else set()

    def _strings(self) -> list[str]:
        root = ElementTree.fromstring(self.zip.read("xl/sharedStrings.xml"))
        # phonetic hints are no part of the text
        return ["".join(t.text or "" for part in (si, *si.findall(f"{_MAIN}r")) for t in part.findall(f"{_MAIN}t")) for si in root.findall(f"{_MAIN}si")]

    def _dates(self) -> set[int]:
        root = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
        formats = root.find(f"{_MAIN}cellXfs")
        found = set()
        for i, x in enumerate(formats if formats is not None else ()):
            k = int(x.get("numFmtId", 0))
            plain = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", codes.get(k, ""))
            if k in _DATE_FORMATS or re.search("[ymdhs]", plain, re.I):
                found.add(i)
        return found

    def _value(self, cell: ElementTree.Element, formulas: bool) -> str | None:
        formula = cell.find(f"{_MAIN}f")
        if formulas and formula is not None:
            return f"={formula.text or ''}"
        kind, v = cell.get("t", "n"), cell.find(f"{_MAIN}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return "TRUE" if v.text == "1" else "FALSE"
        if kind != "n":
            return v.text
        number = float(v.text)
        if int(cell.get("s", 0)) in self.dates:
            moment = self.epoch + datetime.timedelta(days=number)
            return moment.date().isoformat() if number == int(number) else moment.replace(microsecond=0).isoformat()
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

    def rows(self, sheet: str, formulas: bool = False) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number, cells by column number); rows without cells are left out."""
        place = 0
        with self.zip.open(self.paths[sheet]) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                place = int(row.get("r", place + 1))
                cells, at = {}, 0
                for c in row.findall(f"{_MAIN}c"):
                    at = column_number(c.get("r")) if c.get("r") else at + 1
                    value = self._value(c, formulas)
                    if value is not None:
                        cells[at] = value
                row.clear()
                if cells:
                    yield place, cells

    def merged(self, sheet: str) -> list[tuple[int, int, int, int]]:
        """First row, first column, last row, last column of merged ranges."""
        out = []
        with self.zip.open(self.paths[sheet]) as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag == f"{_MAIN}mergeCell":
                    a, _, b = e.get("ref").partition(":")
                    b = b or a
                    out.append((int(re.search(r"\d+", a).group()), column_number(a), int(re.search(r"\d+", b).group()), column_number(b)))
        return out


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    """One partition per workbook; which of its sheets are wanted is found where it is read."""

    def __init__(self, options: dict[str, str], width: int):
        self.options, self.width = options, width

    def partitions(self) -> list[InputPartition]:
        return [_File(path) for path in self.options["path"].split(",")]

    def read(self, partition: _File) -> Iterator[tuple]:
        formulas = self.options.get("formulas", "false").lower() == "true"
        book = Workbook(partition.path)
        for sheet in chosen_sheets(list(book.paths), self.options.get("sheet"), partition.path):
            for number, cells in book.rows(sheet, formulas):
                if max(cells) > self.width:
                    raise ValueError(f"row {number} of {sheet} has cells behind column {column_letters(self.width)}; read more columns")
                yield (partition.path, sheet, number, *(cells.get(k) for k in range(1, self.width + 1)))


def chosen_sheets(names: list[str], chosen: str | None, path: str = "") -> list[str]:
    """All sheets, or the one of that name, or else of that place."""
    if chosen is None:
        return names
    if chosen in names:
        return [chosen]
    if chosen.isdigit() and 1 <= int(chosen) <= len(names):
        return [names[int(chosen) - 1]]
    raise ValueError(f"no sheet {chosen} in {path}")


def distinct_sheets(names: list[str], chosen: list[str | None]) -> list[str]:
    """The sheets of several periods by name, place or, where none is given, order; each must be another one."""
    found = [chosen_sheets(names, str(k + 1) if c is None else c)[0] for k, c in enumerate(chosen)]
    if len(set(found)) != len(found):
        raise ValueError(f"sheets are named twice: {found}")
    return found


class XlsxSource(DataSource):
    """Format ``xlsx``: options path (comma separated), sheet (name or place), columns (how many), formulas."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        width = int(self.options.get("columns", 26))
        return "file string, sheet string, row_number int, " + ", ".join(f"c{k} string" for k in range(1, width + 1))

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options), len(schema) - 3)


def read_xlsx(spark: SparkSession, *paths: str, sheet: str | int | None = None, columns: int = 26, formulas: bool = False) -> DataFrame:
    """file, sheet, row_number and cells c1, c2, … of workbooks on a file system that all executors see.

    A cell behind the last of ``columns`` is an error, never left out.
    """
    spark.dataSource.register(XlsxSource)
    reader = spark.read.format("xlsx").option("path", ",".join(paths)).option("columns", columns).option("formulas", str(formulas))
    if sheet is not None:
        reader = reader.option("sheet", str(sheet))
    return reader.load()


def resolve_columns(header: dict[str, str], required: list[str], aliases: dict[str, list[str]] | None = None, key=lambda x: x.strip().lower(), strict: bool = False) -> dict[str, str]:
    """Cell column of each required header, found by key or alias. Missing and repeated ones are errors; ``strict`` wants the exact order."""
    if strict:
        got = [v for _, v in sorted(header.items(), key=lambda x: int(x[0][1:])) if v]
        if got != required:
            raise ValueError(f"headers differ: {got[:8]} instead of {required[:8]}")
    found = {}
    for name in required:
        wanted = {key(x) for x in [name, *(aliases or {}).get(name, [])]}
        hits = [c for c, v in header.items() if v is not None and key(v) in wanted]
        if len(hits) != 1:
            raise ValueError(f"header {name} is {'missing' if not hits else 'repeated'}")
        found[name] = hits[0]
    return found


def named_table(raw: DataFrame, required: list[str], header_row: int = 1, aliases: dict[str, list[str]] | None = None, strict: bool = False) -> DataFrame:
    """Rows below the header of one sheet, with the required columns under their names and the row number."""
    cells = [c for c in raw.columns if re.fullmatch(r"c\d+", c)]
    head = raw.where(f"row_number = {header_row}").select(*cells).first()
    if head is None:
        raise ValueError(f"no header in row {header_row}")
    of = resolve_columns(head.asDict(), required, aliases, strict=strict)
    rows = raw.where(f"row_number > {header_row}")
    return rows.selectExpr("sheet", "row_number", *[f"{of[n]} AS `{n}`" for n in required])
