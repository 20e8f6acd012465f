"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

A derivative names the record it comes from (WARC-Refers-To with target URI and date), keeps the source's
HTTP headers and digests, and carries a digest of its own block. Record ids are derived from content, so
a rerun, or a task run twice, gives the same ids.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import table, text_pieces

#: Date of records whose source gives none; a parameter, so that runs can be repeated.
NO_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

#: What starts a piece of markup: a comment, or "<" with a letter, "/", "!" or "?" behind it. Any other "<" is text.
_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_BOUND = re.compile(r"[<>]")
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)")
_ATTRIBUTE = re.compile(r"([^\s=<>\"'/]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")
#: Elements that go with their content. The head is none of them, since its end tag may be left out.
_DROPPED = frozenset(("script", "style", "noscript", "template", "title"))
_BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main nav ol option p pre section table tbody td tfoot th thead tr ul".split()
)
_SPACES = re.compile(r"[ \t\r\f\v ]+")
_LINES = re.compile(r" ?\n[ \n]*")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(parts))}>"


class _Page:
    """Tags of a page from left to right, each found by searching on from the last, so that no text is searched twice.

    ``ends`` remembers for every element that no end tag follows any more, which a page of many open ones would ask again and again.
    """

    def __init__(self, page: str):
        self.page, self.low, self.ends = page, page.lower(), set()

    def after(self, mark: str, at: int) -> int:
        """Place behind the next ``mark``, or the end of the page."""
        if mark in self.ends:
            return len(self.page)
        found = self.low.find(mark, at)
        if found < 0:
            self.ends.add(mark)
            return len(self.page)
        return found + len(mark)

    def pieces(self) -> Iterator[tuple[int, int, str, int]]:
        """(start of the tag, end of what goes with it, name in small letters with its slash, end of the tag itself)."""
        at, page = 0, self.page
        while (opened := _OPEN.search(page, at)) is not None:
            start = opened.start()
            if page.startswith("<!--", start):
                at = self.after("-->", start + 4)
                yield start, at, "!", at
                continue
            bound = _BOUND.search(page, start + 1)
            if bound is None:
                return
            close = bound.start()
            if page[close] == "<":
                # a tag that another one interrupts is text
                at = close
                continue
            name = _NAME.match(page, start + 1, close)
            tag = page[start + 1 : name.end()].lower() if name else "!"
            at = close + 1
            if tag in _DROPPED:
                at = self.after("</" + tag, at)
                at = self.after(">", at) if at < len(page) else at
            yield start, at, tag, close + 1


def plain_text(page: str) -> str:
    """Visible text of a page: one line per block, white space collapsed, entities resolved."""
    page = page.replace("\n", " ")
    out, last = [], 0
    for start, end, tag, _ in _Page(page).pieces():
        out.append(page[last:start])
        if tag.removeprefix("/") in _BLOCKS or tag in _DROPPED:
            out.append("\n")
        last = end
    out.append(page[last:])
    return _LINES.sub("\n", _SPACES.sub(" ", entities.unescape("".join(out)))).strip()


def page_fields(page: str) -> list[tuple[str, str]]:
    """Fields of a metadata record that the page itself gives: its title, its language and its links in order."""
    title = lang = None
    links = []
    for start, end, tag, close in _Page(page).pieces():
        if tag == "title" and title is None:
            body = page[close:end]
            cut = body.lower().rfind("</title")
            title = body[:cut] if cut >= 0 else body
        wanted = {"html": "lang", "a": "href"}.get(tag)
        if wanted:
            for m in _ATTRIBUTE.finditer(page, start + 1 + len(tag), close - 1):
                value = next((x for x in m.groups()[1:] if x is not None), None)
                if m.group(1).lower() == wanted and value is not None:
                    if tag == "a":
                        links.append(("outlink", entities.unescape(value)))
                    elif lang is None:
                        lang = value
                    break
    fields = [] if title is None else [("title", " ".join(entities.unescape(title).split()))]
    return fields + ([("languages-declared", lang.lower())] if lang else []) + links


def http_message(payload: bytes, content_type: str = "text/html; charset=utf-8") -> tuple[str, bytes]:
    """Header and whole block of a response for a bare page."""
    header = f"HTTP/1.1 200 OK{CRLF}Content-Type: {content_type}{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}"
    return header, header.encode() + payload


def derive(uri: str, header: str, payload: bytes, block: bytes, source_id: str, date: str) -> list[dict]:
    """The metadata and the conversion record of one response."""
    page = payload.decode("utf-8", "replace")
    payload_digest, block_digest = digest(payload), digest(block)
    text = plain_text(page)
    fields = [
        ("source-payload-digest", payload_digest), ("source-block-digest", block_digest),
        *((f"http-{k.strip().lower()}", v.strip()) for k, _, v in (line.partition(":") for line in header.split(CRLF)[1:] if ":" in line)),
        ("text-characters", str(len(text))), *page_fields(page),
    ]
    meta = "".join(f"{k}: {' '.join(v.split())}{CRLF}" for k, v in fields)
    out = []
    for kind, mime, body in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain", text)):
        own = digest(body.encode())
        number = record_id(kind, source_id, own)
        head = [
            "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {number}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
            f"WARC-Refers-To: {source_id}", f"WARC-Refers-To-Target-URI: {uri}", f"WARC-Refers-To-Date: {date}",
            f"WARC-Block-Digest: {own}", f"Content-Type: {mime}", f"Content-Length: {len(body.encode())}",
        ]
        out.append({
            "record_type": kind, "record_id": number, "refers_to": source_id, "target_uri": uri, "date": date,
            "content_type": mime, "content_length": len(body.encode()), "block_digest": own,
            "source_payload_digest": payload_digest, "source_block_digest": block_digest, "source_headers": header.rstrip(CRLF),
            "warc_header": CRLF.join(head) + CRLF + CRLF, "block": body,
        })
    return out


FIELDS = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, content_length long,"
    " block_digest string, source_payload_digest string, source_block_digest string, source_headers string, warc_header string, block string"
)


def _types(schema: str) -> list[pa.DataType]:
    return [pa.int64() if part.split()[1] == "long" else pa.string() for part in schema.split(",")]


def page_derivatives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", date: str = NO_DATE) -> DataFrame:
    """Two rows per page, metadata and conversion, with page_id.

    A page is taken as the payload of a response. Null pages and addresses count as empty; equal rows
    give equal records. Every row is made where its page is read: nothing is shuffled.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.coalesce(F.col(url_column), F.lit("")).alias("url"), F.coalesce(F.col(html_column), F.lit("")).alias("text")
    )
    names = ["page_id", *(part.split()[0] for part in FIELDS.split(","))]
    types = [pa.int64(), *_types(FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches, limit=1 << 20):
            out = []
            for page, url, text in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
                payload = text.encode()
                header, block = http_message(payload)
                source = record_id("response", str(page), url, digest(payload))
                out += [(page, *r.values()) for r in derive(url, header, payload, block, source, date)]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return rows.mapInArrow(run, "page_id long, " + FIELDS)


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in small letters, block) of the records of a plain or gzip stream, one record in memory at a time.

    A record whose length is missing or no number has an empty block; what follows is skipped up to the next record.
    """
    stream = stream if isinstance(stream, io.BufferedReader) else io.BufferedReader(stream)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while line := stream.readline().decode("utf-8", "replace").rstrip("\r\n"):
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size = fields.get("content-length", "")
        yield fields, stream.read(int(size)) if size.isascii() and size.isdigit() else b""


def _opened(path: str, mode: str) -> BinaryIO:
    """A file of any file system that Arrow can reach by its address."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    if mode == "r":
        return system.open_input_stream(place, compression=None)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place, compression=None)


RESPONSES = "file string, record_id string, uri string, date string, header string, payload binary, block binary"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_id, uri, date, header, payload, block) of the response records of WARC files.

    Spark lists the files; a task streams its files record by record, so that no file is held whole.
    """
    names = [part.split()[0] for part in RESPONSES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 5 + [pa.binary()] * 2
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with _opened(name, "r") as stream:
                    for f, block in parse_records(stream):
                        if f.get("warc-type") == "response":
                            head, _, payload = block.partition(b"\r\n\r\n")
                            row = (name, f.get("warc-record-id", ""), f.get("warc-target-uri", ""), f.get("warc-date", NO_DATE), head.decode("latin-1"), payload, block)
                            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.mapInArrow(run, RESPONSES)


def response_derivatives(responses: DataFrame) -> DataFrame:
    """Derivatives of records from ``read_responses``; the source's own ids and dates are kept."""
    names = [part.split()[0] for part in FIELDS.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                got = derive(r["uri"], r["header"], r["payload"], r["block"], r["record_id"], r["date"])
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in got], t) for n, t in zip(names, _types(FIELDS), strict=True)], names=names)

    return responses.mapInArrow(run, FIELDS)


def warcinfo(name: str, date: str = NO_DATE) -> bytes:
    """The record that opens a file."""
    body = f"software: rosterline{CRLF}format: WARC File Format 1.1{CRLF}".encode()
    head = [
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('warcinfo', name)}", f"WARC-Date: {date}", f"WARC-Filename: {name}",
        f"WARC-Block-Digest: {digest(body)}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}",
    ]
    return (CRLF.join(head) + CRLF + CRLF).encode() + body


def write_warc(derivatives: DataFrame, path: str, date: str = NO_DATE) -> list[str]:
    """Derivatives as WARC files, one per task that has any; returns the files of the written set.

    A file starts with its warcinfo record, and every record, with the two line ends behind it, is a gzip member of its
    own. Files are named by task and attempt and the names of the finished ones come back to the driver, which lists
    them in ``_files``; what a lost attempt left is not in that list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name, out, records = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz", None, 0
        for batch in batches:
            for head, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    out = _opened(f"{path}/{name}", "w")
                    out.write(gzip.compress(warcinfo(name, date) + (CRLF + CRLF).encode(), mtime=0))
                out.write(gzip.compress((head + block + CRLF + CRLF).encode(), mtime=0))
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["name", "records"])

    done = sorted(tuple(r) for r in derivatives.select("warc_header", "block").mapInArrow(run, "name string, records long").collect())
    with _opened(f"{path}/_files", "w") as listing:
        listing.write("".join(f"{name} {n}\n" for name, n in done).encode())
    return [name for name, _ in done]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_derivatives(table(spark, sf_dir, "pages"))
