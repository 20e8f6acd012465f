"""Vector near-duplicates, web archive derivatives and the pipeline against plain versions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import time
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from rosterline.llm import common, decontam, embedding, packing, pii, quality, warc


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([centres, centres[rng.integers(0, 6, 120)] + rng.normal(scale=0.05, size=(120, 16))])
    rows = [(i, v.tolist(), 0, 1, "x") for i, v in enumerate(x)]
    rows += [(900, rows[0][1], 0, 1, "x"), (901, rows[0][1], 0, 1, "x"), (901, rows[1][1], 0, 1, "x")]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0, 3.0]]
    rows += [(1000 + i, v, 0, 1, "x") for i, v in enumerate(odd)] + [(None, rows[0][1], 0, 1, "x")]
    schema = "vec_id long, embedding array<double>, label int, t int, uid string"
    got = embedding.near_vectors(spark.createDataFrame(rows, schema).repartition(3), cap=40).toPandas()
    sound = [(r[0], np.array(r[1])) for r in rows if r[0] is not None and r[0] < 1000]
    unit = np.array([v / np.linalg.norm(v) for _, v in sound])
    links = unit @ unit.T >= 0.95
    want = Counter()
    root = list(range(len(sound)))
    for _ in sound:
        root = [min(root[j] for j in np.flatnonzero(links[i])) for i in range(len(sound))]
    for i, (k, _) in enumerate(sound):
        component = min(sound[j][0] for j in range(len(sound)) if root[j] == root[i])
        want[k, int(links[i].sum()) - 1, component] += 1
    found = Counter((int(r.vec_id), int(r.n_links), int(r.component_id)) for r in got.itertuples() if r.vec_id == r.vec_id and r.vec_id < 1000)
    pairs_found, pairs_there = sum(n * k[1] for k, n in found.items()), sum(n * k[1] for k, n in want.items())
    assert 0.95 * pairs_there <= pairs_found <= pairs_there
    assert {k[0]: k[2] for k in found} == {k[0]: k[2] for k in want}
    alone = got[got.vec_id >= 1000]
    assert len(alone) == 7 and (alone.n_links == 0).all() and (alone.component_id == alone.vec_id).all() and alone.kept.all()
    assert len(got) == len(rows) and not got[got.vec_id.isna()].kept.any()
    assert embedding.near_vectors(spark.createDataFrame([], schema)).count() == 0


PAGE = (
    "<!DOCTYPE html><html lang='FR'><head><title> A &amp; B </title><style>p{}</style></head><body><!-- <p>no</p> -->"
    "<h1>Head</h1><p>One <b>two</b>\n three<br>four &lt;5&gt;</p><script>var t='</p>';</script><a href=\"/x?a=1&amp;b=2\">link</a><div>end"
)


def test_plain_text_and_fields():
    assert warc.plain_text(PAGE) == "Head\nOne two three\nfour <5>\nlink\nend"
    assert warc.page_fields(PAGE) == [("title", "A & B"), ("languages-declared", "fr"), ("outlink", "/x?a=1&b=2")]
    assert warc.plain_text("") == "" and warc.plain_text("a < b") == "a < b"
    assert warc.plain_text("<p>" + "x" * 100_000 + "<script>never closed") == "x" * 100_000


def test_text_after_an_open_head_and_comparisons_stay():
    page = "<!DOCTYPE html><html><head><title>x</title><style>p{}</style><body><p>All the text of the page</p></body></html>"
    assert warc.plain_text(page) == "All the text of the page" and warc.page_fields(page) == [("title", "x")]
    assert warc.plain_text("<p>if a < b and c > d</p><?php no ?><!x>end</ p>") == "if a < b and c > d\nend"
    assert warc.plain_text("<head><meta charset=utf-8><p>first</p><HEADER>top</HEADER>") == "first\ntop"


def test_derivatives_link_back(spark):
    rows = [(1, "http://a/", PAGE, "x"), (1, "http://a/", PAGE, "x"), (2, None, None, None), (None, "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    got = warc.page_derivatives(pages).collect()
    assert Counter(r["record_type"] for r in got) == {"metadata": 4, "conversion": 4}
    for r in got:
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(r["block"].encode()).digest()).decode()
        assert f"WARC-Refers-To: {r['refers_to']}\r\n" in r["warc_header"] and r["content_length"] == len(r["block"].encode())
    first = [r for r in got if r["page_id"] == 1]
    assert len({r["record_id"] for r in first}) == 2 and len({r["refers_to"] for r in first}) == 1
    assert warc.page_derivatives(pages.limit(0)).count() == 0


def test_warc_files_round_trip(spark, tmp_path):
    body = PAGE.encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Cache: hit\r\n\r\n" + body
    record = (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Date: 2020-01-02T03:04:05Z\r\nWARC-Target-URI: http://h/\r\nContent-Length: {len(block)}\r\n\r\n"
    ).encode() + block + b"\r\n\r\n"
    request = b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nGET\r\n\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.warc.gz").write_bytes(gzip.compress(request) + gzip.compress(record))
    (tmp_path / "in/b.warc").write_bytes(request + record)
    made = warc.response_derivatives(warc.read_responses(spark, str(tmp_path / "in")))
    warc.write_warc(made, str(tmp_path / "out"))
    files = [tmp_path / "out" / line.split()[0] for line in (tmp_path / "out/_files").read_text().splitlines()]
    back = [r for f in files for r in warc.parse_records(f.open("rb"))]
    assert [f["warc-type"] for f, _ in back].count("warcinfo") == len(files) and len(back) == 4 + len(files)
    # every record is a gzip member of its own
    assert sum(f.read_bytes().count(b"\x1f\x8b\x08") for f in files) == len(back)
    for fields, data in back:
        if fields["warc-type"] == "warcinfo":
            continue
        assert fields["warc-refers-to"] == "<urn:uuid:1>" and fields["warc-refers-to-date"] == "2020-01-02T03:04:05Z"
        assert fields["warc-block-digest"] == warc.digest(data)
        if fields["warc-type"] == "metadata":
            text = data.decode()
            assert f"source-payload-digest: {warc.digest(body)}" in text and "http-x-cache: hit" in text and f"source-block-digest: {warc.digest(block)}" in text
        else:
            assert data.decode() == warc.plain_text(PAGE)


def test_malformed_headers_do_not_stop_a_file():
    bad = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: x\r\n\r\nlost\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    good = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    assert [(f["warc-type"], b) for f, b in warc.parse_records(io.BytesIO(bad + good))] == [("response", b""), ("response", b""), ("resource", b"ok")]


@pytest.mark.parametrize("part", ["<a ", "<script ", "<title>", "<script>", "<!--", "<a href=", "<p", "</", "<a href='x' "])
def test_open_markup_takes_time_in_proportion(part):
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        warc.plain_text(part * n)
        warc.page_fields(part * n)
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 0.2


def test_records_equal_plain_ones(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {(r["page_id"], r["record_type"]): r for r in warc.page_derivatives(pages).collect()}
    given = pages.collect()
    assert len(got) == 2 * len(given)
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for p in given:
        body = p["html"].encode()
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}"
        meta, text = got[p["page_id"], "metadata"], got[p["page_id"], "conversion"]
        for r in (meta, text):
            fields = dict(line.split(": ", 1) for line in r["warc_header"].strip().splitlines()[1:])
            assert fields["WARC-Refers-To"] == r["refers_to"] == meta["refers_to"] and fields["WARC-Record-ID"] == r["record_id"] != meta["refers_to"]
            assert fields["WARC-Target-URI"] == fields["WARC-Refers-To-Target-URI"] == p["url"] and fields["WARC-Refers-To-Date"] == fields["WARC-Date"]
            assert fields["WARC-Block-Digest"] == sha(r["block"].encode()) and int(fields["Content-Length"]) == len(r["block"].encode())
            assert r["source_payload_digest"] == sha(body) and r["source_block_digest"] == sha(f"{head}\r\n\r\n".encode() + body) and r["source_headers"] == head
        want = [f"outlink: {' '.join(html.unescape(x).split())}" for x in re.findall(r'<a\b[^<>]*?\bhref="([^"]*)"', p["html"])]
        lines = meta["block"].split("\r\n")
        assert [x for x in lines if x.startswith("outlink")] == want and f"text-characters: {len(text['block'])}" in lines
        assert f"source-payload-digest: {sha(body)}" in lines and "http-content-type: text/html; charset=utf-8" in lines


def test_text_agrees_with_a_parser(spark):
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.hidden = [], 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "head")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style", "head")

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data)

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(100).collect():
        parser = Text()
        parser.feed(r["html"])
        squeeze = lambda t: re.sub(r"\s+", "", t)
        assert squeeze(warc.plain_text(r["html"])) == squeeze("".join(parser.out)), html.unescape(r["url"])


def test_stages_bound_arrow_batches(spark):
    name, sf = "spark.sql.execution.arrow.maxBytesPerBatch", "/root/testdata/sf0.001"
    before = spark.conf.get(name)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    try:
        for label, stage in corpus_pipeline.STAGES:
            if label == "personal_data":
                continue
            spark.conf.set(name, "64m")
            stage(spark, docs, sf)
            rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 10000) AS text")
            sizes = rows.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
            assert max(r["n"] for r in sizes) <= 2 * common.BATCH_BYTES and len(sizes) > 1, label
        spark.conf.set(name, "1m")
        common.lean(spark)
        with common.small_batches(spark):
            assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


def test_a_worker_keeps_the_words_of_one_operator():
    for _ in range(2):
        quality.features("some words here")
        assert [*common._KEPT] == [quality.__name__] and "words" in common._KEPT[quality.__name__]
        packing.encoder(None)("some words here")
        assert [*common._KEPT] == [(packing.__name__, None)]
    assert packing.encoder(None) is packing.encoder(None)
    assert [*common.tidy(iter, (packing.__name__, None))([1, 2])] == [1, 2] and common._KEPT
    assert [*common.tidy(iter)([1, 2])] == [1, 2] and not common._KEPT


def test_pipeline_stages_hold(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert kept.columns == docs.columns and set(after) <= set(before)
        if name == "quality":
            assert not any(labels.get(i, (1, 0))[0] == 0 for i in after)
            assert sum(labels.get(i) == (1, 0) for i in after) >= 0.97 * sum(labels.get(i) == (1, 0) for i in before)
        if name == "near_duplicates":
            assert len(set(after.values())) == len(after)
        if name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not any(item in text for item in items for text in after.values())
            assert all(any(" ".join(decontam.normal(w) for w in item.split())[:60] in " ".join(decontam.normal(w) for w in before[i].split()) for item in items) for i in set(before) - set(after))
        if name == "personal_data":
            assert set(after) == set(before)
            assert all(re.sub(r"\[(EMAIL|IP|CARD|PHONE|LEARNED)\]", "", after[i]) == after[i] or before[i] != after[i] for i in after)
            assert pii.personal_data(kept).where("spans <> ''").count() == 0
            assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf).toPandas()
    assert set(pieces.doc_id) == set(after) and pieces.groupby("sequence_id").length.sum().max() <= 1024
