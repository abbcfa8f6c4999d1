"""WARC derivatives: response records to linked metadata and plain-text conversion records.

``responses`` writes pages as WARC response records; ``derive`` reads such records (any WARC/1.x
response) and writes two records for each: ``metadata`` (warc-fields: the source's HTTP status
and headers, WARC headers, digests, title, number of links) and ``conversion`` (the page's plain
text). Both refer to the response by WARC-Refers-To, name each other by WARC-Concurrent-To, keep
its target URI and date, and carry digests of their own blocks; identifiers follow from the
response's identifier, so reruns agree.

Cases: a null page is an empty payload; a null URL leaves out WARC-Target-URI; a record that
does not parse, or is no response, yields one row with ``error`` and no record; a payload that
does not match its digest is converted and marked ``digest_ok = false``, one without a digest
null; several responses with one identifier (repeated rows) give equal records; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.llm.store import table

#: Capture date written into records made from the pages table (which has none).
CAPTURED = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("5f1d6a7e-31cb-4d2a-9a55-0f4a1f3f6c02")

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<(/?[a-zA-Z][a-zA-Z0-9]*)[^<>]*>|<![^<>]*>",
                     re.S | re.I)
_BREAKS = frozenset("address article aside blockquote br dd div dl dt figcaption footer form h1 h2 h3 h4 h5 h6 "
                    "head header hr li main nav ol p pre section table td th title tr ul".split())
_TITLE = re.compile(r"<title\b[^<>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"<a\s[^<>]*href\s*=", re.I)

RECORD_SCHEMA = ("refers_to string, warc_type string, record_id string, concurrent_to string, target_uri string, "
                 "warc_date string, source_digest string, digest_ok boolean, block_digest string, content_length bigint, "
                 "record binary, error string")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join(parts))}>"


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; header values are kept on one line."""
    lines = ["WARC/1.1"] + [f"{k}: {' '.join(v.split())}" for k, v in headers] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(raw: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers (in order) and block of one record."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC/1.x header")
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in " \t" and headers:  # folded header
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line: {line[:60]}")
        headers.append((name.strip(), value.strip()))
    size = dict((k.lower(), v) for k, v in headers).get("content-length", "")
    if not size.isdigit() or int(size) > len(rest):
        raise ValueError("bad Content-Length")
    return headers, rest[:int(size)]


def plain_text(page: str) -> str:
    """Visible text: markup, comments, scripts and styles go, block elements end lines."""
    def swap(m):
        tag = (m.group(2) or "").lstrip("/").lower()
        return "\n" if tag in _BREAKS else ""

    text = html.unescape(_MARKUP.sub(swap, page))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def derivatives(raw: bytes) -> list[dict]:
    """The metadata and conversion rows of one response record."""
    try:
        headers, block = read_record(raw)
        get = {k.lower(): v for k, v in headers}.get
        if get("warc-type") != "response" or not get("warc-record-id"):
            raise ValueError("not a response record with an identifier")
        head, sep, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace").split("\r\n")
        if not sep or not http[0].startswith("HTTP/"):
            raise ValueError("no HTTP response in the block")
    except ValueError as err:
        return [{"error": str(err)}]
    source, uri, date = get("warc-record-id"), get("warc-target-uri"), get("warc-date")
    stated = get("warc-payload-digest")
    ids = {t: record_id(source, t) for t in ("metadata", "conversion")}
    page = payload.decode("utf-8", "replace")
    title = _TITLE.search(page)
    fields = [("http-status", http[0])] + [("http-header", h) for h in http[1:]]
    fields += [("source-" + k.lower(), v) for k, v in headers if k.lower() not in ("content-length", "warc-type")]
    fields += [("computed-payload-digest", digest(payload)), ("conversion-id", ids["conversion"]),
               ("title", html.unescape(title.group(1)) if title else ""), ("links", str(len(_LINK.findall(page))))]
    blocks = {"metadata": "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode(),
              "conversion": plain_text(page).encode()}
    kinds = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    out = []
    for kind, body in blocks.items():
        other = ids["conversion" if kind == "metadata" else "metadata"]
        named = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source),
                 ("WARC-Concurrent-To", other)]
        named += [("WARC-Target-URI", uri)] if uri else []
        named += [("WARC-Date", date)] if date else []
        named += [("WARC-Source-Payload-Digest", stated)] if stated else []
        named += [("WARC-Block-Digest", digest(body)), ("Content-Type", kinds[kind])]
        out.append({"refers_to": source, "warc_type": kind, "record_id": ids[kind], "concurrent_to": other, "target_uri": uri,
                    "warc_date": date, "source_digest": stated, "digest_ok": stated and stated == digest(payload),
                    "block_digest": digest(body), "content_length": len(body), "record": write_record(named, body)})
    return out


def response_record(url: str | None, page: str | None, date: str, key: str) -> bytes:
    """A page as a WARC response record with an HTTP block."""
    payload = (page or "").encode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http + payload
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url or "", date, digest(payload)))]
    headers += [("WARC-Target-URI", url)] if url else []
    headers += [("WARC-Date", date), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                ("Content-Type", "application/http; msgtype=response")]
    return write_record(headers, block)


def responses(pages: DataFrame, date: str = CAPTURED) -> DataFrame:
    """(page_id, response): each page as a response record."""
    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "html")]
            made = [response_record(u, h, date, str(i)) for i, u, h in zip(*cols)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(made, pa.binary())], names=["page_id", "response"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, response binary")


def derive(records: DataFrame, column: str = "response", key: str = "page_id") -> DataFrame:
    """Two rows (metadata, conversion) for each response record, after ``key``."""
    kind = records.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = {"digest_ok": pa.bool_(), "content_length": pa.int64(), "record": pa.binary()}

    def run(batches):
        for b in batches:
            keys, rows = b.column(key), [derivatives(r or b"") for r in b.column(column).to_pylist()]
            at = pa.array([i for i, found in enumerate(rows) for _ in found], pa.int64())
            flat = [r for found in rows for r in found]
            cols = [pa.array([r.get(n) for r in flat], types.get(n, pa.string())) for n in names]
            yield pa.RecordBatch.from_arrays([keys.take(at), *cols], names=[key, *names])

    return records.select(key, column).mapInArrow(run, f"{key} {kind}, {RECORD_SCHEMA}")


def op6_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    found = derive(responses(table(spark, sf_dir, "pages")))
    return found.withColumn("record", F.decode("record", "utf-8"))
