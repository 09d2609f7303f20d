"""WARC archives: writing pages as records, and reading them back whole.

Writing.  Equal payloads are found by digest and length; the page with the
smallest id is the ``response`` record, others are ``revisit`` records that
refer to it (payloads under ``min_revisit_bytes`` are always responses).  A
response holds an HTTP message whose body is in chunked transfer framing.  A
block over ``segment_bytes`` is cut: the first segment is the response, the
rest are ``continuation`` records with the origin's id and segment numbers, the
last one with the total length.  Records go through Spark's text writer with the
record separator as line end, so files land in any store Spark can write and a
lost executor's task is simply rerun; files hold at most ``FILE_RECORDS``.

Reading.  Archive files are read as binary rows and cut into records by their
Content-Length.  Records are grouped by origin identifier: single ones are whole
already; continuations meet their first segment, are ordered by segment
number, and the numbers and the total length are verified.  The chunked
framing is then decoded and the payload's digest compared.  Damaged records
come back with ``error`` set instead of a payload.

Null html is the empty payload.  Every row is a record with an id of its own,
made of the page id, the payload's digest and length, and the number of the copy:
repeated rows are repeated records, and other html under one page_id is another
record.  A revisit refers to copy 0 of the first page.  The copies of one page
are numbered in one task.  An empty table gives no archive and no rows; a null
page_id is refused by the writer (records need an id) and gets no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 4096
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "page-record")
DATE = "2020-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def record_id(page_id: int, digest: str, size: int, copy: int = 0, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}/{size}/{copy}/{segment}')}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i:i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES))]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunk(body: bytes) -> bytes:
    """Payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is cut off")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            if body[end:].count(b"\r\n\r\n") == 0:
                raise ValueError("last chunk is cut off")
            return b"".join(out)
        if size < 0 or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def header(fields: list[tuple[str, object]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def page_records(page_id: int, url: str | None, payload: bytes, refers_to: int | None, segment_bytes: int, copy: int = 0) -> list[bytes]:
    """The records of one page row, without the separator that follows each."""
    digest, size = base32_sha1(payload), len(payload)
    origin = record_id(page_id, digest, size, copy)
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A") or None
    own = [("WARC-Record-ID", origin), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        extra = [("WARC-Refers-To", record_id(refers_to, digest, size)), ("WARC-Refers-To-Page-ID", refers_to), ("WARC-Payload-Length", size),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [header([("WARC-Type", "revisit"), *own, *extra, ("Content-Length", 0)])]
    block = _HTTP + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    number = [("WARC-Segment-Number", 1)] if len(parts) > 1 else []
    out = [header([("WARC-Type", "response"), *own, *number, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(parts[0]))]) + parts[0]]
    for i, part in enumerate(parts[1:], 2):
        total = [("WARC-Segment-Total-Length", len(block))] if i == len(parts) else []
        out.append(header([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, digest, size, copy, i)), ("WARC-Date", DATE), ("WARC-Target-URI", target),
                           ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", i), *total, ("Content-Length", len(part))]) + part)
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write every page below ``path`` as compressed archive files."""
    html = F.coalesce(pages[html_col].cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), html.alias("html")).where("page_id is not null")
    rows = rows.withColumns({"digest": F.unhex(F.sha1("html")), "size": F.length("html")})
    keys = rows.where(F.col("size") >= min_revisit_bytes).select("page_id", "digest", "size")
    first = keys.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    revisits = keys.join(first, ["digest", "size"]).where("page_id > refers_to").select("page_id", "digest", "size", "refers_to").distinct()
    copy = F.row_number().over(Window.partitionBy("page_id", "digest", "size").orderBy(F.lit(0))) - 1

    def write(batches):
        for b in batches:
            out = [r for i, u, h, to, k in zip(*(c.to_pylist() for c in b.columns)) for r in page_records(i, u, h, to, segment_bytes, k)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = rows.join(revisits, ["page_id", "digest", "size"], "left").select("page_id", "url", "html", "refers_to", copy.alias("copy")).mapInArrow(write, "value binary")
    (records.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse_records(data: bytes):
    """(fields, block) of every record of an archive file; the block is None where the file ends within it."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, size = end + 4, int(fields.get("content-length", "0"))
        yield fields, data[start:start + size] if start + size <= len(data) else None
        at = start + size
        while data[at:at + 2] == b"\r\n":
            at += 2


def whole(fields: dict, block: bytes | None) -> dict:
    """One page row from a record whose block is complete."""
    to = fields.get("warc-refers-to-page-id")
    row = {"page_id": int(fields["warc-page-id"]), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "refers_to": int(to) if to else None,
           "payload": None, "payload_bytes": None, "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "error": None}
    if row["record_type"] == "revisit":
        return row | {"payload_bytes": int(fields["warc-payload-length"])}
    try:
        if block is None:
            raise ValueError("record is cut off")
        head, _, body = block.partition(b"\r\n\r\n")
        payload = dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body
        if base32_sha1(payload) != row["payload_digest"]:
            raise ValueError("payload digest differs")
        return row | {"payload": payload, "payload_bytes": len(payload)}
    except ValueError as e:
        return row | {"error": str(e)}


def reassemble(segments: list[tuple[int, bytes | None, int | None, dict | None]]) -> dict | None:
    """One page row from the segments (number, block, total length, fields of the first) of an origin."""
    unique = {s[0]: s for s in sorted(segments, key=lambda s: s[0])}
    fields = unique[1][3] if 1 in unique else None
    if fields is None:
        return None  # continuations without their origin name no page
    total = [s[2] for s in unique.values() if s[2] is not None]
    blocks = [s[1] for s in unique.values()]
    row = {k: None for k in ("payload", "payload_bytes")}
    if sorted(unique) != list(range(1, len(unique) + 1)) or any(b is None for b in blocks) or len(total) != 1 or sum(map(len, blocks)) != total[0]:
        return whole(fields, None) | row | {"error": "segments are missing or their total length differs"}
    return whole(fields, b"".join(blocks))


_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())])
_PAGE_SQL = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, error string"
_SEGMENT = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("block", pa.binary()), ("total", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))])
_SEGMENT_SQL = "origin string, number int, block binary, total long, fields map<string,string>"
ROWS = 256


def segment_row(fields: dict, block: bytes | None) -> dict:
    total, first = fields.get("warc-segment-total-length"), fields["warc-segment-number"] == "1"
    return {"origin": fields["warc-record-id"] if first else fields["warc-segment-origin-id"], "number": int(fields["warc-segment-number"]), "block": block,
            "total": int(total) if total else None, "fields": list(fields.items()) if first else None}


def _in_batches(rows, schema):
    part = []
    for row in rows:
        part.append(row)
        if len(part) == ROWS:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist(part, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Page rows (id, url, type, payload, its length and digest, error) of all archive files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def of_files(make, segmented: bool, schema):
        def run(batches):
            for b in batches:
                for content in b.column(0).to_pylist():
                    found = parse_records(gzip.decompress(content))
                    yield from _in_batches((make(f, x) for f, x in found if ("warc-segment-number" in f) == segmented), schema)
        return run

    def join(batches):
        for b in batches:
            groups = ([(s["number"], s["block"], s["total"], dict(s["fields"]) if s["fields"] else None) for s in group] for group in b.column(0).to_pylist())
            yield from _in_batches((row for row in map(reassemble, groups) if row), _PAGE)

    single = files.mapInArrow(of_files(whole, False, _PAGE), _PAGE_SQL)
    segments = files.mapInArrow(of_files(segment_row, True, _SEGMENT), _SEGMENT_SQL)
    grouped = segments.groupBy("origin").agg(F.collect_list(F.struct("number", "block", "total", "fields")).alias("segments"))
    return single.union(grouped.select("segments").mapInArrow(join, _PAGE_SQL))
