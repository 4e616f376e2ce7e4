"""Derivatives of WARC responses: a metadata and a plain-text conversion record for each.

Both records point to their source by ``WARC-Refers-To``, repeat its target and date, and keep
its headers and digests: the metadata record as a JSON block with the WARC and HTTP headers, the
digests the source states and those its bytes have; the conversion record as
``WARC-Source-*`` headers beside its own block digest. Record ids are name-based, so a rerun
makes the same ids.

WARC files are read and written by Spark's text source with the record boundary as line
separator, so a file is split between tasks and a record never passes through the driver. Gzip files
are read whole per file, as Spark does. A payload that holds a record boundary itself cuts its
record short; its stated length then disagrees and ``problem`` says so.

Defined cases: a null or empty record, one without a header end, without an id, or of another length
than it states gives a metadata record whose ``problem`` names the fault (and a conversion record as
far as its text goes, if it is a response); other record types give a metadata record
only; a response without HTTP headers or of a type other than text gives an empty conversion; repeated
records give repeated derivatives; an empty table gives no rows; ``keep`` names the further columns that stay.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.0"
ANY_VERSION = re.compile(rb"WARC/\d+\.\d+")
END = "\r\n\r\n"
BETWEEN = END + "WARC/"  # of any version
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:lathework:warc-derivatives")
FETCHED = "2024-01-01T00:00:00Z"

DERIVED = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length bigint, "
    "block_digest string, source_block_digest string, source_payload_digest string, source_headers string, problem string, block string, record binary"
)
DERIVED_NAMES = [c.split(" ")[0] for c in DERIVED.split(", ")]

HEAD = (  # up to its end tag; without one before the body, up to the first tag or text that it cannot hold
    r"<head\b(?![-:])(?:(?:[^<]++|<(?!/head\s*>|body\b))*+</head\s*>|[^>]*+>?(?:\s++|<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title)\b(?:.*?</\2\s*>|.*?(?=</head\b|<body\b)|.*)"
    r"|<(?:meta|link|base|basefont|bgsound)\b[^>]*+>?|</(?:meta|link|base|script|style|noscript|template|title)\b[^>]*+>?|<[!?][^>]*+>?)*+(?:</head\s*>)?)")
HIDDEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|{HEAD}", re.DOTALL | re.IGNORECASE)
BLOCK_TAG = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*(?:>|\Z)",
    re.IGNORECASE)
TAG = re.compile(r"<[/!?A-Za-z][^>]*(?:>|\Z)")
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.DOTALL | re.IGNORECASE)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def name_based(kind: str, *parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(10).join((kind, *parts)))}>"


def header_lines(text: str) -> dict[str, str]:
    """Names in lower case; a name that repeats has its values joined by a comma; folded lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in text.split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name, value = name.strip().lower(), value.strip()
            out[name] = f"{out[name]}, {value}" if name in out else value
    return out


def parse(record: bytes | None) -> tuple[dict[str, str], bytes, str]:
    """Headers, block and the fault of a record, empty if it has none."""
    if not record:
        return {}, b"", "empty record"
    if not ANY_VERSION.match(record):
        return {}, record, "no version line"
    head, there, block = record.partition(END.encode())
    headers = header_lines(head.decode("utf-8", "replace"))
    if not there:
        return headers, b"", "no header end"
    length = headers.get("content-length", "")
    if not length.isdigit():
        return headers, block, "no content length"
    if len(block) < int(length):
        return headers, block, "shorter than stated"
    rest = block[int(length):]
    problem = "longer than stated" if rest.strip(b"\r\n") else "" if "warc-record-id" in headers else "no record id"
    return headers, block[:int(length)], problem


def plain_text(page: str) -> str:
    """Title and visible text; blocks are lines, white space in a line is one blank."""
    title = TITLE.search(page)
    body = TAG.sub("", BLOCK_TAG.sub("\n", HIDDEN.sub("\n", page)))
    lines = [title[1] if title else "", *body.split("\n")]
    cleaned = (" ".join(html.unescape(line).split()) for line in lines)
    return "\n".join(line for line in cleaned if line)


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers and payload; a block that does not begin as HTTP is all payload."""
    if not block.startswith(b"HTTP/"):
        return "", {}, block
    head, _, payload = block.partition(END.encode())
    status, _, lines = head.decode("iso-8859-1").partition("\r\n")
    return status, header_lines(lines), payload


def converted(http: dict[str, str], payload: bytes) -> str:
    kind = http.get("content-type", "").split(";")[0].strip().lower()
    if not kind.startswith("text/") and kind != "application/xhtml+xml":
        return ""
    named = CHARSET.search(http.get("content-type", ""))
    try:
        text = payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        text = payload.decode("utf-8", "replace")
    return plain_text(text) if "html" in kind else text


def written(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its closing line ends, which the writer's line separator adds."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + END).encode() + block


def derive(record: bytes | None) -> list[tuple]:
    """The derivatives of one record, in the order of DERIVED."""
    warc, block, problem = parse(record)
    source, target, date = warc.get("warc-record-id", ""), warc.get("warc-target-uri", ""), warc.get("warc-date", "")
    response = warc.get("warc-type", "").lower() == "response"
    status, http, payload = split_http(block) if response else ("", {}, block)
    block_digest, payload_digest = digest(block), digest(payload)
    facts = {
        "warc_headers": warc, "http_status": status, "http_headers": http, "payload_length": len(payload),
        "block_digest": block_digest, "payload_digest": payload_digest, "problem": problem,
    }
    source_headers = json.dumps({"warc": warc, "http": http}, sort_keys=True, ensure_ascii=False)
    stated_block, stated_payload = warc.get("warc-block-digest", block_digest), warc.get("warc-payload-digest", payload_digest)
    named = source or digest(record or b"")
    parts = [("metadata", "application/json", json.dumps(facts, sort_keys=True, ensure_ascii=False))]
    if response:
        parts.append(("conversion", "text/plain; charset=UTF-8", converted(http, payload)))
    out = []
    for kind, content_type, text in parts:
        data = text.encode("utf-8", "replace")
        own, own_id = digest(data), name_based(kind, named, target, date)
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Refers-To", source), ("WARC-Target-URI", target), ("WARC-Date", date),
                   ("WARC-Block-Digest", own), ("WARC-Source-Block-Digest", stated_block), ("WARC-Source-Payload-Digest", stated_payload), ("Content-Type", content_type)]
        out.append((kind, own_id, source or None, target or None, date or None, content_type, len(data), own, stated_block, stated_payload, source_headers,
                    problem or None, data.decode(), written(headers, data)))
    return out


def derivatives(records: DataFrame, keep: list[str] | None = None, column: str = "record") -> DataFrame:
    """Derived records of every row; ``keep`` names columns of ``records`` that each of its derivatives repeats."""
    keep = [c for c in keep or [] if c not in DERIVED_NAMES]
    kinds = {f.name: f.dataType.simpleString() for f in records.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), DERIVED])
    integers, binaries = {"content_length"}, {"record"}
    types = [pa.int64() if n in integers else pa.binary() if n in binaries else pa.string() for n in DERIVED_NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, rows = [], []
            for i, record in enumerate(batch.column(len(keep))):
                made = derive(record.as_py())
                sources += [i] * len(made)
                rows += made
            columns = list(zip(*rows)) if rows else [()] * len(types)
            place = pa.array(sources, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(place) for j in range(len(keep))), *(pa.array(c, t) for c, t in zip(columns, types))], [*keep, *DERIVED_NAMES])

    return records.select(*keep, F.col(column).cast("binary").alias("_record")).mapInArrow(run, schema)


def response_records(pages: DataFrame, date: str = FETCHED) -> DataFrame:
    """``page_id``, ``url`` and ``record``: every page as a response record, built in the JVM."""
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\r\n"))
    payload = F.coalesce(F.col("html"), F.lit(""))
    size = lambda c: F.octet_length(c).cast("string")
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=UTF-8"), line("Content-Length: ", size(payload)), F.lit("\r\n"), payload)
    url = F.coalesce(F.col("url"), F.lit(""))
    hashed = F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, payload).cast("binary"))
    dashed = F.regexp_replace(hashed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    base32 = lambda c: F.concat(F.lit("md5:"), F.md5(c.cast("binary")))

    def whole(block):
        return F.concat(
            line(VERSION), line("WARC-Type: response"), line("WARC-Record-ID: <urn:uuid:", dashed, ">"), line("WARC-Target-URI: ", url), line("WARC-Date: ", date),
            line("WARC-Block-Digest: ", base32(block)), line("WARC-Payload-Digest: ", base32(payload)), line("Content-Type: application/http; msgtype=response"),
            line("Content-Length: ", size(block)), F.lit("\r\n"), block)

    return pages.select("page_id", "url", F.transform(F.array(http), whole)[0].cast("binary").alias("record"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record`` of every record in the files below ``path``, without its closing line ends; bytes of any kind stay as they are."""
    rows = spark.read.option("lineSep", BETWEEN).text(path).where("value != ''")
    begun = rows.select(F.when(F.col("value").startswith("WARC/"), F.col("value")).otherwise(F.concat(F.lit("WARC/"), F.col("value"))).alias("value"))
    head = F.substring_index("value", END, 1)
    stated = F.octet_length(head) + len(END) + F.regexp_extract(head, "(?im)^content-length:[ \\t]*([0-9]{1,18})[ \\t\\r]*$", 1).try_cast("bigint")
    raw = F.col("value").cast("binary")
    # only a file's last record brings its line ends along; a block may end in such bytes itself
    closed = F.col("value").endswith(END) & ~F.coalesce(F.octet_length("value") == stated, F.lit(False))
    return begun.select(F.when(closed, F.substring(raw, F.lit(1), F.length(raw) - len(END))).otherwise(raw).alias("record"))


def write_warc(records: DataFrame, path: str, compression: str | None = None) -> None:
    """The ``record`` column as WARC files, one per partition."""
    writer = records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END)
    (writer.option("compression", compression) if compression else writer).text(path)
