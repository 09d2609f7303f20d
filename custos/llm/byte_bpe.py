"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split by the tokenizer's pattern.  The distinct pre-tokens of a slice
of texts are looked up together in a minimal perfect hash of the vocabulary
(levels of bit arrays; a key's number is the rank of its bit), which answers
every pre-token that is a token itself; hash and bytes of the slot are compared,
so other pre-tokens are told apart.  A miss is merged: its bytes form a linked
list, a heap holds the adjacent pairs by rank, then place, and the least pair is
joined until none is left, in O(n log n) for a pre-token of n bytes.

Null text is the empty text and has no ids; a null id keeps its row; repeated
rows each give their row; very long texts are split piece by piece and very long
pre-tokens merged by the heap, none is cut; equal ranks merge from the left; an
empty table gives an empty table; other columns of the input, whatever their
names, are not read.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from custos.llm.common import mix64, slices

BATCH_CHARS = 1_000_000
PIECES_AT_ONCE = 1_000_000
CACHE_BYTES = 128 << 20
ENTRY_BYTES = 190


class MinimalPerfectHash:
    """Numbers 0 .. n - 1 of n distinct keys, by levels of bit arrays.

    A key is placed at the first level at which no other remaining key has its
    bit; its number is the count of bits set before its own.
    """

    def __init__(self, keys: list[bytes], room: float = 2.0):
        h = self.hashes(keys)
        if len(np.unique(h)) != len(h):
            raise ValueError("two keys are equal, or share a 64-bit hash")
        self.levels, left = [], h
        while len(left):
            size = max(1, int(room * len(left)))
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((size, alone))
            left = left[~alone[at]]
        bits = np.concatenate([b for _, b in self.levels] or [np.zeros(0, bool)])
        self.before = np.concatenate([[0], np.cumsum(bits)])
        self.start = np.cumsum([0, *(s for s, _ in self.levels)])
        self.slot_hash = np.empty(len(h), np.uint64)
        number = self._numbers(h)
        self.slot_hash[number] = h
        self.slot_key: list[bytes] = [b""] * len(keys)
        for i, key in zip(number.tolist(), keys):
            self.slot_key[i] = key

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(h + np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)

    def _numbers(self, h: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (size, bits) in enumerate(self.levels):
            at = self._place(h[left], level, size)
            hit = bits[at]
            out[left[hit]] = self.before[self.start[level] + at[hit]]
            left = left[~hit]
        return out

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of each key, -1 for what is not a key."""
        h = self.hashes(keys)
        number = self._numbers(h)
        for i in np.flatnonzero(number >= 0).tolist():
            n = number[i]
            if self.slot_hash[n] != h[i] or self.slot_key[n] != keys[i]:
                number[i] = -1
        return number


class Vocabulary:
    """Ranks of a ``.tiktoken`` file (a base64 token and its rank a line) and the pattern before the merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
        self.pattern = regex.compile(pattern)
        self.tokens = dict(zip(self.ranks.values(), self.ranks))
        self.index = MinimalPerfectHash(list(self.ranks))
        self.rank_of = np.array([self.ranks[k] for k in self.index.slot_key], np.int32)
        self.byte_rank = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.pair_rank = np.array([self.ranks.get(bytes([i >> 8, i & 255]), -1) for i in range(1 << 16)], np.int32)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def merged(self, piece: bytes) -> list[int]:
        """Ranks of one pre-token, the pair of least rank joined first, the leftmost of equal ones."""
        return next(self.merge_all([piece]))

    def merge_all(self, pieces: list[bytes]):
        """``merged`` of each pre-token in turn; ranks of bytes and of their pairs are looked up for all of them together.

        A part of a pre-token is named by its first place; ``after`` links it to the next part and ``before`` to the one to
        its left.  A heap entry holds a pair's rank and then its place; it is stale once the pair there has another rank.
        """
        get, pop, push = self.ranks.get, heapq.heappop, heapq.heappush
        longest = max(map(len, pieces), default=0)
        bits = longest.bit_length()
        mask = (1 << bits) - 1
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int32)
        place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        pair_at = np.append(self.pair_rank[data[:-1] << 8 | data[1:]], -1)[:len(data)]
        pair_at[ends[sizes > 0] - 1] = -1
        ranks_at, pairs_at = self.byte_rank[data].tolist(), pair_at.tolist()
        known = np.flatnonzero(pair_at >= 0)
        entries = (pair_at[known].astype(np.int64) << bits | place[known]).tolist()
        heap_ends = np.searchsorted(known, ends).tolist()
        ups, downs = list(range(1, longest + 1)), list(range(-1, longest))
        at = h = 0
        for piece, end, heap_end in zip(pieces, ends.tolist(), heap_ends):
            n = end - at
            rank, pair, heap = ranks_at[at:end], pairs_at[at:end], entries[h:heap_end]
            after, before = ups[:n], downs[:n + 1]
            at, h = end, heap_end
            heapq.heapify(heap)
            while heap:
                top = pop(heap)
                i = top & mask
                if pair[i] != top >> bits:
                    continue
                b = after[i]
                c = after[i] = after[b]
                before[c] = i
                rank[i] = pair[i]
                rank[b] = pair[b] = -1
                if c < n:
                    pair[i] = r = get(piece[i:after[c]], -1)
                    if r >= 0:
                        push(heap, r << bits | i)
                else:
                    pair[i] = -1
                if i:
                    a = before[i]
                    pair[a] = r = get(piece[a:c], -1)
                    if r >= 0:
                        push(heap, r << bits | a)
            yield [r for r in rank if r >= 0]

    def learn(self, new: list[str]) -> None:
        """Put the ids of ``new`` pre-tokens in ``known``: whole tokens by the hash, the rest by merging."""
        keys = [p.encode() for p in new]
        number = self.index.find(keys)
        whole = self.rank_of[number].astype("<i4").tobytes()
        number = number.tolist()
        merged = self.merge_all([k for k, n in zip(keys, number) if n < 0])
        for i, (piece, n) in enumerate(zip(new, number)):
            if n >= 0:
                ids = whole[4 * i:4 * i + 4]
            else:
                found = next(merged)
                ids = pack(f"<{len(found)}i", *found)
            self.known[piece] = ids
            self.held += ENTRY_BYTES + 2 * len(keys[i]) + len(ids)

    def split(self, text: str):
        """Lists of the pre-tokens of a text; a very long text comes in several."""
        if len(text) <= PIECES_AT_ONCE:
            yield self.pattern.findall(text)
        else:
            yield from itertools.batched((m.group() for m in self.pattern.finditer(text)), PIECES_AT_ONCE)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        if max(map(len, texts), default=0) > PIECES_AT_ONCE:
            out = []
            for text in texts:
                ids = bytearray()
                for pieces in self.split(text):
                    if self.held > CACHE_BYTES:
                        self.known.clear()
                        self.held = 0
                    self.learn(list(set(pieces).difference(self.known)))
                    ids += b"".join(map(self.known.__getitem__, pieces))
                out.append(bytes(ids))
            return out
        cut = [self.pattern.findall(t) for t in texts]
        self.learn(list(set().union(*cut).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]

    def decode(self, ids: list[int]) -> bytes | None:
        """The bytes of ``ids``; None where one of them is not an id."""
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return None


@functools.cache
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ids (array<int>), the ranks of its whole text."""
    def run(batches):
        for b in batches:
            vocab = vocabulary(path, pattern)
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                ids = vocab.encode(texts[lo:hi])
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                if ends[-1] < 2 ** 31:
                    values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], lists], ["doc_id", "ids"])
                else:
                    raise ValueError("a text of over 2^31 ids does not fit an array")

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows (doc_id, ids) with ``decoded``, the bytes that the ids stand for; null where an id is unknown or ids are null."""
    def run(batches):
        for b in batches:
            vocab = vocabulary(path, pattern)
            for lo, hi in slices(b.column(1).value_lengths().fill_null(0).to_pylist(), BATCH_CHARS):
                ids = b.column(1)[lo:hi]
                ends, values = ids.offsets.to_numpy(), ids.values.fill_null(-1).to_numpy()
                out = [vocab.decode(values[i:j].tolist()) if known else None
                       for known, i, j in zip(ids.is_valid().to_pylist(), ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], ids, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the decimal ids, joined by a space, and of the decoded bytes."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
