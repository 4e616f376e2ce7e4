from __future__ import annotations

import base64
import hashlib
import json

import pytest

from lathework.llm import warc
from lathework.session import scratch_folder


def record(block, **headers):
    named = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://a/", "WARC-Date": "2024-01-01T00:00:00Z"} | {k.replace("_", "-"): v for k, v in headers.items()}
    lines = "".join(f"{k}: {v}\r\n" for k, v in named.items() if v is not None)
    length = "" if "Content-Length" in named else f"Content-Length: {len(block)}\r\n"
    return ("WARC/1.0\r\n" + lines + length + "\r\n").encode() + block


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nX-A: 1\r\n\r\n"
BODY = "<html><head><title>T\xe9</title></head><body><p>One &amp; two<script>x</script><p>three</body>".encode("latin-1")


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_links_headers_and_digests():
    source = record(HTTP + BODY, WARC_Payload_Digest="sha1:STATED")
    meta, conv = (dict(zip(warc.DERIVED_NAMES, r)) for r in warc.derive(source))
    for r in (meta, conv):
        assert (r["refers_to"], r["target_uri"], r["problem"]) == ("<urn:uuid:1>", "http://a/", None)
        assert (r["source_block_digest"], r["source_payload_digest"]) == (sha(HTTP + BODY), "sha1:STATED")
        headers, block, problem = warc.parse(r["record"])
        assert not problem and block == r["block"].encode() and r["content_length"] == len(block)
        assert headers["warc-refers-to"] == "<urn:uuid:1>" and headers["warc-block-digest"] == sha(block) == r["block_digest"]
    assert conv["block"] == "Té\nOne & two\nthree"
    facts = json.loads(meta["block"])
    assert facts["payload_digest"] == sha(BODY) and facts["http_headers"]["x-a"] == "1" and facts["warc_headers"]["warc-payload-digest"] == "sha1:STATED"
    assert meta["record_id"] != conv["record_id"] and warc.derive(source) == warc.derive(source)


@pytest.mark.parametrize("data,problem,kinds", [
    (None, "empty record", 1), (b"", "empty record", 1), (b"junk", "no version line", 1), (b"WARC/1.0\r\nWARC-Type: response\r\n", "no header end", 2),
    (record(b"x", Content_Length="9"), "shorter than stated", 2), (record(b"xy", Content_Length="1"), "longer than stated", 2),
    (record(b"x", Content_Length="z"), "no content length", 2), (record(b"x", WARC_Record_ID=None), "no record id", 2),
    (record(b"x", WARC_Type="request"), None, 1), (record(HTTP.replace(b"text/html", b"image/png") + b"\x89"), None, 2),
])
def test_faults_are_named(data, problem, kinds):
    rows = [dict(zip(warc.DERIVED_NAMES, r)) for r in warc.derive(data)]
    assert [r["warc_type"] for r in rows] == ["metadata", "conversion"][:kinds]
    assert {r["problem"] for r in rows} == {problem}


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_files_round_trip(spark, compression):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3)
    folder = scratch_folder(spark)
    records = warc.response_records(pages)
    warc.write_warc(records, f"{folder}/responses", compression)
    read = warc.read_warc(spark, f"{folder}/responses")
    assert sorted(bytes(r.record) for r in read.collect()) == sorted(bytes(r.record) for r in records.collect())
    derived = warc.derivatives(read)
    assert derived.where("problem IS NOT NULL").count() == 0
    warc.write_warc(derived, f"{folder}/derived", compression)
    again = [warc.parse(bytes(r.record)) for r in warc.read_warc(spark, f"{folder}/derived").collect()]
    assert len(again) == 2 * pages.count() and not any(problem for _, _, problem in again)
    ids = {warc.parse(bytes(r.record))[0]["warc-record-id"] for r in records.collect()}
    assert {h["warc-refers-to"] for h, _, _ in again} == ids


def test_odd_pages(spark):
    rows = [(1, "u", "<p>é" * 30_000, "x", 1), (2, None, None, "x", 2), (None, "u", "", None, None), (2, None, None, "x", 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block string, problem int")
    out = warc.derivatives(warc.response_records(pages).join(pages.select("page_id", "block").distinct(), "page_id", "left"), ["page_id", "block"])
    assert out.columns.count("block") == 1
    got = out.collect()
    assert len(got) == 8 and all(r.problem is None and r.refers_to for r in got)
    assert {len(r.block) for r in got if r.page_id == 1 and r.warc_type == "conversion"} == {59_999}
    assert warc.derivatives(warc.response_records(pages.limit(0))).count() == 0


def test_a_head_without_end_tag_ends_where_the_body_begins():
    body = "<p>First words</p><div>second words</div>"
    for head in ("<head><meta charset=x><title>T</title><script>a < b</script>", "<HEAD lang=en>\n<title>T</title><!-- <p>no</p> -->", "<head><title>T</title><script>'<body>'</script>"):
        for start in ("", "<body class=x>", "</head><body>"):
            assert warc.plain_text(f"<html>{head}{start}{body}</html>") == "T\nFirst words\nsecond words", (head, start)
    assert warc.plain_text("<head><title>T</title>loose words<p>more") == "T\nloose words\nmore"
    assert warc.plain_text("<head><title>T</title><script>open</head><body>words") == "T\nwords"
    assert warc.plain_text("<head><title>T") == "T"


def test_files_of_any_version_are_split(spark, tmp_path):
    record = "WARC/{}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{}>\r\nContent-Length: 5\r\n\r\nwords\r\n\r\n"
    (tmp_path / "a.warc").write_bytes("".join(record.format(v, i) for i, v in enumerate(["1.1", "1.1", "1.0", "0.18"])).encode())
    read = [bytes(r.record) for r in warc.read_warc(spark, str(tmp_path)).collect()]
    assert sorted(read) == sorted(record.format(v, i)[:-4].encode() for i, v in enumerate(["1.1", "1.1", "1.0", "0.18"]))
    assert all(warc.parse(r)[1:] == (b"words", "") for r in read)


def test_payloads_of_any_bytes_round_trip(spark):
    import random

    chance = random.Random(4)
    blocks = [HTTP + BODY, HTTP.replace(b"text/html", b"image/png") + bytes(range(256)), b"", b"\r\n", b"\xff\xfe\r\n\r\n\xe9"]
    blocks += [HTTP + bytes(chance.randrange(256) for _ in range(chance.randrange(400))) for _ in range(40)]
    records = [record(b, WARC_Record_ID=f"<urn:uuid:{i}>") for i, b in enumerate(blocks)]
    folder = scratch_folder(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder + "/all.warc")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    stream.write(b"".join(r + b"\r\n\r\n" for r in records))
    stream.close()
    read = warc.read_warc(spark, folder)
    assert sorted(bytes(r.record) for r in read.collect()) == sorted(records)
    made = warc.derivatives(read).where("warc_type = 'metadata'").collect()
    assert {r.problem for r in made} == {None} and {r.source_block_digest for r in made} == {sha(b) for b in blocks}
