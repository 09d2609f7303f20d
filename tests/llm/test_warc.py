"""Writing and reading archives, exactly."""

import gzip
import hashlib
import random

from custos.llm import warc

PAGES = "page_id long, url string, html string, value string, payload string"


def brute(pages, least=0):
    out = []
    for i, _, html, *_ in pages:
        data = (html or "").encode()
        same = [j for j, _, h, *_ in pages if j is not None and (h or "").encode() == data]
        first = min(same)
        again = len(data) >= least and first < i
        out.append((i, len(data), warc.base32_sha1(data), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rng = random.Random(5)
    body = lambda n: "".join(rng.choice("abé\r\n<0 ") for _ in range(n))
    big, edge = body(60_000), "x" * warc.CHUNK_BYTES
    htmls = [None, "", "a", "a", big, big, edge, "\r\n\r\nWARC/1.1\r\n\r\n", "0\r\n\r\n", "ü" * 30_000, "\r\n", "a\n"]
    pages = [(i, None if i % 4 == 3 else f"http://h/{i}\r\nx: y", h, "v", "p") for i, h in enumerate(htmls)]
    df = spark.createDataFrame(pages, PAGES)
    for least in (0, 2):
        path = str(tmp_path / f"a{least}")
        warc.write_archives(df, path, min_revisit_bytes=least, segment_bytes=5000)
        rows = warc.read_archives(spark, path).collect()
        assert all(r["error"] is None for r in rows)
        assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == brute(pages, least)
        for r in rows:
            if r["record_type"] == "response":
                assert bytes(r["payload"]) == (htmls[r["page_id"]] or "").encode()


def test_repeated_null_and_no_rows(spark, tmp_path):
    rows = [(1, "u", "same", "", ""), (1, "u", "same", "", ""), (2, "u", "same", "", ""), (None, "u", "x", "", "")]
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path / "r"))
    got = warc.read_archives(spark, str(tmp_path / "r")).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_damaged_segments_are_reported():
    parts = []
    for record in warc.page_records(7, "u", b"y" * 20_000, None, 6000):
        fields, block = next(warc.parse_records(record + b"\r\n\r\n"))
        s = warc.segment_row(fields, block)
        parts.append((s["number"], s["block"], s["total"], dict(s["fields"]) if s["fields"] else None))
    assert len(parts) == 4
    assert warc.reassemble(parts[::-1])["payload"] == b"y" * 20_000
    assert warc.reassemble(parts[:1] + parts[2:])["error"]
    assert warc.reassemble(parts[:-1])["error"]
    assert warc.reassemble(parts[1:]) is None
    assert warc.reassemble([*parts[:2], (3, parts[2][1][:-1], None, None), parts[3]])["error"]
    assert hashlib.sha1(b"").digest() and warc.base32_sha1(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_every_row_has_its_own_records(spark, tmp_path):
    rng = random.Random(6)
    page = lambda n: "".join(rng.choice("abcdefgh <>") for _ in range(n))
    big, other, third = page(60_000), page(60_000), page(40_000)
    pages = [(1, "u", big), (1, "u", big), (1, "v", big), (2, "u", "small"), (2, "u", "small"), (3, "u", other), (3, "u", third), (4, "u", third), (5, "u", big), (5, "u", "own"), (5, "u", big)]
    warc.write_archives(spark.createDataFrame([(*p, "", "") for p in pages], PAGES), str(tmp_path / "c"))
    rows = warc.read_archives(spark, str(tmp_path / "c")).collect()
    first = {}
    for i, _, h in sorted(pages, key=lambda p: p[0]):
        first.setdefault(h, i)
    want = [(i, warc.base32_sha1(h.encode()), len(h), "response" if first[h] == i else "revisit", None if first[h] == i else first[h], h.encode() if first[h] == i else None) for i, _, h in pages]
    assert all(r["error"] is None for r in rows)
    assert sorted(((r["page_id"], r["payload_digest"], r["payload_bytes"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"])) for r in rows), key=str) == sorted(want, key=str)
    files = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "c").glob("*.gz"))
    fields = [f for f, _ in warc.parse_records(files)]
    ids = [f["warc-record-id"] for f in fields]
    assert len(ids) == len(set(ids)) and {f["warc-refers-to"] for f in fields if "warc-refers-to" in f} <= set(ids)
