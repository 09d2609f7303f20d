"""Best-fit-decreasing packing of tokenised documents into fixed sequences.

A document is its token ids and one closing id 0.  Documents longer than a
sequence are cut so that all pieces but the first are full.  Pieces are dealt
to shards of at most ``shard_rows`` pieces (the shard count follows the number
of pieces); each shard packs longest first, and finds the tightest open
sequence through a segment tree over remaining capacities: a leaf per capacity,
a node true when some open sequence below it has that room.  One partly filled
tail per shard is all that sharding adds.

Null text is the empty text (its piece is the closing id alone); every row
gives its own pieces, repeated rows too; a null id stays null; very long texts
are cut into as many pieces as they need; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from custos.llm.common import slices, stored

SEQUENCE = 2048
SHARD_ROWS = 1 << 16
CACHE_UNITS = 600_000
UNITS_IN_A_ROW = 512
BATCH_CHARS = 4_000_000


@functools.cache
def _tokenizer(path: str):
    """The tokenizer, the bytes that each id stands for (their number), its added tokens, and the ids of units seen before."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    vocabulary = t.get_vocab()
    width = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        width[i] = len(token)  # byte-level: a character for each byte
    return t, width, [added.content for added in t.get_added_tokens_decoder().values()], {}


_ODD_SPACE = re.compile(r" (?:\s|$)")


def units(text: str) -> list[str]:
    """Cut ``text`` at each space that a visible character follows; the space goes with what follows.

    Byte-level BPE starts a word at every such space, so the ids of the text
    are those of its units in a row.  The units come without that space.
    """
    parts = text.split(" ")
    if not _ODD_SPACE.search(text):
        return parts
    out = parts[:1]
    for part in parts[1:]:
        if not part or part[0].isspace():
            out[-1] += " " + part
        else:
            out.append(part)
    return out


def _encode_units(new: list[str], tok, width: np.ndarray, known: dict[str, bytes]) -> None:
    """Put the ids of ``new`` units, each after a space, in ``known``.

    Many are encoded in a row, and the ids are dealt out by the bytes they
    stand for.
    """
    rows = [new[a:a + UNITS_IN_A_ROW] for a in range(0, len(new), UNITS_IN_A_ROW)]
    for lo in range(0, len(rows), 64):
        some = rows[lo:lo + 64]
        texts = [" " + " ".join(r) for r in some]
        for row, text, e in zip(some, texts, tok.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            want = np.cumsum([len(u) for u in row] if text.isascii() else [len(u.encode()) for u in row]) + np.arange(1, len(row) + 1)
            ends = np.cumsum(width[ids])
            stop = np.searchsorted(ends, want) + 1
            if (ends[stop - 1] != want).any():
                raise ValueError("the tokenizer is not byte-level with words that begin at spaces")
            data, a = ids.tobytes(), 0
            for u, b in zip(row, (4 * stop).tolist()):
                known[u] = data[a:b]
                a = b


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers.

    A text that spells an added token, which takes spaces around it from their
    words, is encoded in one piece.
    """
    tok, width, added, known = _tokenizer(path)
    if len(known) > CACHE_UNITS:
        known.clear()
    cut = [[t] if any(a in t for a in added) else units(t) for t in texts]
    first = [c.pop(0) for c in cut]
    _encode_units(list(set().union(*cut).difference(known)), tok, width, known)
    heads = tok.encode_batch_fast(first, add_special_tokens=False)
    return [np.array(h.ids, "<u4").tobytes() + b"".join(map(known.__getitem__, c)) for h, c in zip(heads, cut)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Token pieces of every document: place, length, checksum and the ids themselves (as bytes)."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches):
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(token_bytes(texts[lo:hi], tokenizer_path), lo):
                    ids += b"\0\0\0\0"
                    n = len(ids) // 4
                    a, k = 0, 0
                    e = n % sequence or sequence
                    while a < n:
                        row.append(i), piece.append(k), start.append(a), length.append(e - a), crc.append(zlib.crc32(ids[4 * a:4 * e]))
                        a, e, k = e, e + sequence, k + 1
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class OpenBins:
    """Segment tree over remaining capacities; a stack of bins at each leaf."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.n)
        self.bins: list[list[int]] = [[] for _ in range(self.n)]

    def add(self, room: int, b: int) -> None:
        self.bins[room].append(b)
        i = room + self.n
        while i and not self.tree[i]:
            self.tree[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove the bin with the least room that is at least ``need``."""
        tree, i = self.tree, need + self.n
        while not tree[i]:
            while i & 1:  # a right child: nothing larger below its parent
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.n:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.n
        b = self.bins[room].pop()
        if not self.bins[room]:
            tree[i] = 0
            while i > 1 and not tree[i ^ 1]:
                i >>= 1
                tree[i] = 0
        return b, room


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given (decreasing) order."""
    bins, offsets, open_, count = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), OpenBins(capacity), 0
    for i, n in enumerate(lengths.tolist()):
        got = open_.take(n)
        if got is None:
            b, room = count, capacity
            count += 1
        else:
            b, room = got
        bins[i], offsets[i] = b, capacity - room
        if room > n:
            open_.add(room - n, b)
    return bins, offsets


def pack(cut: DataFrame, sequence: int = SEQUENCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``pieces``.

    ``cut`` should be a stored table: it is counted, then dealt to shards.
    """
    shards = max(1, -(-cut.count() // shard_rows))

    def run(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(rows.column("length").to_numpy(), sequence)
        bins += TaskContext.get().partitionId() << 32
        for b in rows.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets)).to_batches(10_000):
            yield b

    return cut.repartition(shards).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer_path, id_col, text_col, sequence), "pieces"), sequence)
