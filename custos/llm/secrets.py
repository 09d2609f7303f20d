"""Secret scan: Aho-Corasick keywords, anchored patterns near hits, checksums.

One automaton over all keywords walks the lower-cased bytes of a text once;
only at its hits is the pattern of that keyword tried, anchored at the hit.
Runs of hex digits have no keyword: the text is transliterated to digit
classes and searched for the one long word ``h * 32``, and only texts that hold
it are scanned for runs.  Matches with an embedded checksum or structure are
kept only when it verifies.

Base kinds (leftmost non-overlapping matches, then the length tests):
``assign``, ``access`` and ``hex``.  Added kinds: ``github`` and ``npm`` tokens
(CRC-32 of the body in the last six base-62 digits), ``jwt`` (header decodes to
a JSON object with ``alg``), ``pem`` (private key block).

Null and empty texts give no spans; every input row gives one output row,
repeated rows included; a null id stays null.  Offsets are code points, end
exclusive.  Whole texts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import functools
import hashlib
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from custos.llm.common import CodePoints, text_bytes

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]

# Keywords and patterns of each kind.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin",),
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?-i:([A-Za-z0-9+/_.=-]+))""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+"),
    "pem": re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----"),
}
HEX_RUN = re.compile(rb"[0-9a-f]+")
HEX_MIN = 32
_HEX_CLASS = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: bytes) -> bytes:
    """CRC-32 of ``body`` in six base-62 digits."""
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _BASE62[d] + out
    return out.encode()


def _json_part(part: bytes):
    try:
        return json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (binascii.Error, ValueError):
        return None


def valid(kind: str, m: re.Match) -> bool:
    """Length, checksum or structure test of one match."""
    if kind == "assign":
        return len(m[2]) >= 8
    if kind == "access":
        return len(m[0]) >= 16
    if kind in ("github", "npm"):
        return checksum62(m[0][4:34]) == m[0][34:40]
    if kind == "jwt":
        head = _json_part(m[1])
        return isinstance(head, dict) and "alg" in head and isinstance(_json_part(m[2]), dict)
    return True


@functools.cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def find_spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in byte offsets of one text."""
    spans, done = [], dict.fromkeys(PATTERNS, 0)
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in automaton().iter(data.lower().decode("latin-1")))
    for start, kind in hits:
        if start >= done[kind] and (m := PATTERNS[kind].match(data, start)):
            done[kind] = m.end()
            if valid(kind, m):
                spans.append((kind, start, m.end()))
    if b"h" * HEX_MIN in data.translate(_HEX_CLASS):
        spans += [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(data) if m.end() - m.start() >= HEX_MIN]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and its ``spans`` (kind, start, end)."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def scan(batches):
        for b in batches:
            out = []
            for data in text_bytes(b.column(1)):
                found = find_spans(data)
                at = CodePoints(data) if found else None
                out.append([{"kind": k, "start": at(s), "end": at(e)} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, schema.field(1).type)], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every found span of their text replaced by ``[kind]``.

    All columns and rows stay; overlapping spans are replaced as one, under the
    kind of the first; a null text stays null; ``n_chars``, if there is such a
    column, becomes the length of the new text (a null text keeps its value).
    """
    def clean(data: bytes) -> bytes:
        out, at, last = [], 0, 0
        for kind, s, e in find_spans(data):
            if s >= last:
                out += [data[at:s], f"[{kind}]".encode()]
                at = e
            last = max(last, e)
            at = max(at, last)
        return b"".join([*out, data[at:]])

    position = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            col = b.column(position)
            new = pa.array([None if null else clean(x).decode() for x, null in zip(text_bytes(col), col.is_null().to_pylist())], col.type)
            yield b.set_column(position, b.schema.field(position), new)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.coalesce(F.length(text_col).cast(docs.schema["n_chars"].dataType), "n_chars")) if "n_chars" in docs.columns else out



def digest(found: DataFrame) -> DataFrame:
    """The counts and span strings of the registered query, by DataFrame functions."""
    joined = lambda col: F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
