"""Text units of files of many kinds, one row per page, sheet row or whole file."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.sources.xlsx import Workbook

UNITS = "path string, sha256 string, kind string, sheet string, number int, text string, status string, error string"
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252")


def decoded(data: bytes, encodings: tuple[str, ...] = ENCODINGS) -> str:
    """Text in the first encoding that fits."""
    for encoding in encodings[:-1]:
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode(encodings[-1])


def _pages(data: bytes) -> Iterator[str]:
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise ValueError("PDF needs the optional library pypdf") from e
    for page in PdfReader(BytesIO(data)).pages:
        yield page.extract_text() or ""


def file_units(path: str, data: bytes, max_pages: int = 0, max_rows: int = 0, encodings: tuple[str, ...] = ENCODINGS) -> Iterator[tuple[str, str, int, str]]:
    """(kind, sheet, number, text); the sheet is named only in workbooks that have several. 0: no limit."""
    suffix = path.lower().rpartition(".")[2]
    if suffix == "pdf":
        for n, text in enumerate(_pages(data), 1):
            if max_pages and n > max_pages:
                return
            yield "pdf", "", n, text
    elif suffix in ("xlsx", "xlsm"):
        book = Workbook(data)
        for sheet in book.paths:
            for n, cells in book.rows(sheet):
                if max_rows and n > max_rows:
                    break
                line = " | ".join(v for _, v in sorted(cells.items()) if v.strip())
                if line:
                    yield "excel", sheet if len(book.paths) > 1 else "", n, line
    elif suffix in ("csv", "tsv"):
        yield "file", "", 0, decoded(data, encodings)
    elif suffix in ("docx", "udf"):
        with zipfile.ZipFile(BytesIO(data)) as z:
            for name in z.namelist():
                if name == "word/document.xml" if suffix == "docx" else name.lower().endswith(".xml"):
                    yield "file", "", 0, " ".join(ElementTree.fromstring(z.read(name)).itertext())
    else:
        raise ValueError(f"{suffix} has to be converted first")


def read_units(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("pdf", "xlsx", "xlsm", "csv", "tsv", "docx", "udf", "rtf", "doc"), max_pages: int = 0, max_rows: int = 0) -> DataFrame:
    """Units of all files under ``path``; a file that cannot be read is one row with its error.

    Status: text_scanned, text_scanned_with_empty_pages, needs_ocr (no page has text) or error, and
    __limited after it where a limit was set. Lock files and tool folders are skipped.
    """
    limited = "__limited" if max_pages or max_rows else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sha = hashlib.sha256(data).hexdigest()
                try:
                    got = list(file_units(name, data, max_pages, max_rows))
                    empty = sum(not t.strip() for k, _, _, t in got if k == "pdf")
                    pages = sum(k == "pdf" for k, *_ in got)
                    status = "needs_ocr" if pages and empty == pages else "text_scanned_with_empty_pages" if empty else "text_scanned"
                    rows = [(name, sha, *u, status + limited, None) for u in got] or [(name, sha, "file", "", 0, "", status + limited, None)]
                except Exception as e:  # one broken file must not end the scan
                    rows = [(name, sha, "", "", 0, "", "error", f"{type(e).__name__}: {e}")]
                types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in UNITS.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    wanted = files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*extensions))
    wanted = wanted.where(~name.startswith("~$") & ~name.startswith("._") & ~F.col("path").rlike(r"/(\.git|__pycache__|node_modules|\.venv)/"))
    return wanted.select("path", "content").mapInArrow(run, UNITS)


def page_parts(pages: DataFrame, size: int = 8, path: str = "path", number: str = "number") -> DataFrame:
    """Pages with the part they fall in when a file is split every ``size`` pages."""
    return pages.withColumn("part", (F.floor((F.col(number) - 1) / size) + 1).cast("int"))
