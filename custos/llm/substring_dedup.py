"""Substring dedup by sliding spans of sentences.

Texts are cut into sentences (after ``.``, ``!`` or ``?`` before white space,
and at line ends).  A sentence of more than ``LONG`` words is cut after the word of
least hash (the last of equal ones) in every window of ``WINDOW`` words, so
pieces have at most ``WINDOW`` words, and a passage is cut alike wherever it
stands: only places within ``WINDOW`` words of its ends depend on what is
around.  Within longer sentences a repeated passage of ``MIN_WORDS + 4 * WINDOW
- 3`` words is thus always met, a shorter one if its cuts allow.  From every sentence on,
and up to every sentence, the shortest run of at least ``MIN_SENTENCES``
consecutive sentences with at least ``MIN_WORDS`` words is hashed (lower-cased
words, to 128 bits), so that the last sentences of a passage are covered like
the first.  The hashes of all runs are counted; all runs of all documents with a
repeated one meet by hash; the first (smallest id, then place) stays, and the
sentences covered by any other are removed from their document.

Null text counts as empty and comes back as empty; texts shorter than a run
are left alone; of exact copies all but the first lose their whole runs;
repeated rows share id and text, so the later of them count as repeats at the
same place and stay whole together with the first; other texts under the same
id, or without one, are documents of their own, in the order of a hash of the text.
An empty table gives an empty result; rows with a null id come after all others;
very long texts are cut whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from custos.llm.common import mix64, slices, stored
from custos.llm.jaccard_join import word_hashes

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG = 20
WINDOW = 8

BROADCAST_TEXTS = 1_000_000
BATCH_CHARS = 2_000_000
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))
_SPACES = bytes(32 if b in (9, 11, 12, 13, 28, 29, 30, 31) else b for b in range(256))
_OTHER_SPACE = re.compile(r"[^\S\x00-\x7F]")
_BREAK = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
_WORD = re.compile(r"\S+")


def cuts(words: list[str]) -> list[int]:
    """Numbers of the words before which a long sentence is cut, its ends among them."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[::-1]
    least = np.lib.stride_tricks.sliding_window_view(h, WINDOW).argmin(axis=1)
    return sorted({0, len(words), *(len(words) - np.arange(len(least)) - least).tolist()})


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of every sentence that has a word, in code points."""
    out, at = [], 0
    for m in [*_BREAK.finditer(text), None]:
        end, following = (m.start(), m.end()) if m else (len(text), 0)
        n = len(text[at:end].split())
        if n > LONG:
            words = [w.span() for w in _WORD.finditer(text, at, end)]
            cut = cuts([text[s:e].lower() for s, e in words])
            out += [(words[i][0], words[j - 1][1], j - i) for i, j in zip(cut, cut[1:])]
        elif n:
            out.append((at, end, n))
        at = following
    return out


def runs(text: str) -> list[tuple[int, int, int]]:
    """(hash, first sentence, one past the last) of the shortest runs that begin and that end at each sentence."""
    found = sentences(text)
    words = [" ".join(text[s:e].lower().split()) for s, e, _ in found]
    places, j, n = set(), 0, 0
    for i in range(len(found)):
        while j < len(found) and (j - i < MIN_SENTENCES or n < MIN_WORDS):
            n += found[j][2]
            j += 1
        if j - i < MIN_SENTENCES or n < MIN_WORDS:
            break
        places.add((i, j))
        n -= found[i][2]
    i = n = 0
    for j in range(1, len(found) + 1):
        n += found[j - 1][2]
        while j - i > MIN_SENTENCES and n - found[i][2] >= MIN_WORDS:
            n -= found[i][2]
            i += 1
        if j - i >= MIN_SENTENCES and n >= MIN_WORDS:
            places.add((i, j))
    out = []
    for i, j in sorted(places):
        h = xxhash.xxh3_64_intdigest(" ".join(words[i:j]))
        out.append((h - (1 << 64) if h >> 63 else h, i, j))
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, text) of every row: texts under one id, or without one, are told apart by hash."""
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


class Words:
    """The words of many texts at once: lower-cased, with the text of each and whether a sentence ends after it."""

    def __init__(self, texts: list[str]):
        low = [t.lower() if t.isascii() else _OTHER_SPACE.sub(" ", t.lower()) for t in texts]
        data = [t.encode().translate(_SPACES) for t in low]
        self.joined = b" ".join([*data, b""])
        self.buffer = np.frombuffer(self.joined, np.uint8)
        space = (self.buffer == 32) | (self.buffer == 10)
        edge = np.flatnonzero(np.diff(space, prepend=True))  # a word begins, ends, begins ...; a space closes the buffer
        self.start, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(np.cumsum([len(d) + 1 for d in data]), self.start, "right")
        last = self.buffer[self.end - 1]
        stop = (last == 46) | (last == 33) | (last == 63)
        if len(stop):
            lines = np.concatenate([[0], np.cumsum(self.buffer == 10)])
            stop[:-1] |= (lines[self.start[1:]] > lines[self.end[:-1]]) | (self.text[1:] != self.text[:-1])
            stop[-1] = True
        self.stop = self._with_cuts(stop)

    def _with_cuts(self, stop: np.ndarray) -> np.ndarray:
        """``stop`` with the places at which long sentences are cut (as ``cuts`` finds them)."""
        last = np.flatnonzero(stop)
        size = np.diff(last, prepend=-1)
        self.of_long = of_long = np.repeat(size > LONG, size)
        if not of_long.any():
            return stop
        hashes = np.zeros(len(stop), np.uint64)
        words = self.joined.split()
        hashes[of_long] = word_hashes([words[i] for i in np.flatnonzero(of_long).tolist()])
        past = np.repeat(last + 1, size)[:len(stop) - WINDOW + 1]
        at = np.flatnonzero(of_long[:len(past)])
        at = at[at + WINDOW <= past[at]]
        least = WINDOW - 1 - np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)[at][:, ::-1].argmin(axis=1)
        out = stop.copy()
        out[at + least] = True
        return out

    def values(self) -> np.ndarray:
        """A 64-bit hash of every word: its bytes times powers, by differences of prefix sums."""
        powers, inverse = power_pair(BASES[0], len(self.buffer))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[self.buffer] * powers[:len(self.buffer)], dtype=np.uint64)])
        return mix64((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))


def sentence_bytes(texts: list[str]) -> list[tuple[bytes, list[int], list[int]]]:
    """For each text its bytes, and where its sentences begin and end in them (as ``sentences``, by byte)."""
    found = Words(texts)
    data = [t.encode() for t in texts]
    blank = [d if t.isascii() else _OTHER_SPACE.sub(lambda m: " " * len(m[0].encode()), t).encode() for t, d in zip(texts, data)]
    buffer = np.frombuffer(b" ".join([*(d.translate(_SPACES) for d in blank), b""]), np.uint8)
    edge = np.flatnonzero(np.diff((buffer == 32) | (buffer == 10), prepend=True))
    origin = np.cumsum([0, *(len(d) + 1 for d in data)])
    after = np.flatnonzero(found.stop) + 1
    before = np.concatenate([[0], after])[:-1]
    of = found.text[before]
    start, end = edge[::2][before] - origin[of], edge[1::2][after - 1] - origin[of]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i, d in enumerate(data):
        lo, hi = bounds[i], bounds[i + 1]
        s, e = start[lo:hi].tolist(), end[lo:hi].tolist()
        if s and not found.of_long[before[lo]] and b"\n" not in d[:s[0]]:
            s[0] = 0  # white space before the first sentence and after the last belongs to them
        if s and not found.of_long[after[hi - 1] - 1] and b"\n" not in d[e[-1]:] and d[e[-1] - 1] not in b".!?":
            e[-1] = len(d)
        out.append((d, s, e))
    return out


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_pair(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n + 1 powers of ``base`` and of its inverse, modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) <= n:
        both = [np.full(n + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
        for p in both:
            p[0] = 1
            np.multiply.accumulate(p, out=p)
        if n > 2 * BATCH_CHARS:  # of a very long text: not kept
            return both[0], both[1]
        _powers[base] = both[0], both[1]
    return _powers[base]


def run_table(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(text, first sentence, one past the last, hash, second hash) of the runs of many texts; as ``runs`` for each.

    The hash of a run is a difference of prefix sums of word hashes times
    powers, brought to the power of its first word.
    """
    found = Words(texts)
    if not len(found.stop):
        return (np.empty(0, np.int64),) * 5
    h, text = found.values(), found.text
    after = np.flatnonzero(found.stop) + 1  # words before the end of each sentence
    before = np.concatenate([[0], after[:-1]])
    of = text[before]  # its text
    n = len(after)
    first = np.searchsorted(of, of)  # first sentence of its text, and one past the last one
    past = np.searchsorted(of, of, "right")
    i = np.arange(n)
    words = np.concatenate([[0], after])
    j = np.maximum(i + MIN_SENTENCES, np.searchsorted(words, before + MIN_WORDS))
    back = np.minimum(i + 1 - MIN_SENTENCES, np.searchsorted(words, after - MIN_WORDS, "right") - 1)
    forth = j <= past
    again = (back >= first) & (back >= 0)
    again[again] &= j[back[again]] != i[again] + 1
    lo, hi = np.concatenate([i[forth], back[again]]), np.concatenate([j[forth], i[again] + 1])
    a, b = words[lo], words[hi]
    hashes = []
    for base in BASES:
        powers, inverse = power_pair(base, len(h))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h ^ np.uint64(base)) * powers[:len(h)], dtype=np.uint64)])
        hashes.append(mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)).view(np.int64))
    return of[lo], lo - first[lo], hi - first[lo], *hashes


def run_hashes(docs: DataFrame, id_col: str, text_col: str, places: bool) -> DataFrame:
    """The 64-bit hash of every run of every row; with ``places`` also its second hash and where it stands."""
    def cut(batches):
        for b in batches:
            texts = ["" if t is None else t for t in b.column(2).to_pylist()]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                text, place, stop, hash_, second = run_table(texts[lo:hi])
                if not places:
                    yield pa.RecordBatch.from_arrays([pa.array(hash_)], ["hash"])
                    continue
                rows = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays([pa.array(hash_), pa.array(second), b.column(0).take(rows), b.column(1).take(rows), pa.array(place.astype(np.int32)), pa.array(stop.astype(np.int32))],
                                                 ["hash", "second", "doc_id", "text_hash", "place", "stop"])

    schema = "hash long, second long, doc_id long, text_hash long, place int, stop int"
    return keyed(docs, id_col, text_col).mapInArrow(cut, schema if places else "hash long")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, place, stop) of every run that is not the first of its 128-bit hash.

    Hashes alone are counted first; places are taken, in a second scan, of
    repeated ones only.  All copies of a run meet in aggregates, never in a
    join: what is not a first place is found by place.
    """
    twice = stored(run_hashes(docs, id_col, text_col, False).groupBy("hash").count().where("count > 1").select("hash"), "repeated_hashes", release=True)
    spans = stored(run_hashes(docs, id_col, text_col, True).join(twice.hint("merge"), "hash", "left_semi"), "runs", release=True)
    where = F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("d"), "text_hash", "place", "stop")
    first = spans.groupBy("hash", "second").agg(F.min(where).alias("first")).select("first.*")
    place = [F.coalesce("doc_id", F.lit(2 ** 63 - 1)) == F.col("d"), *(spans[c] == first[c] for c in ("text_hash", "place", "stop"))]
    return spans.join(first, place, "left_anti").select("doc_id", "text_hash", "place", "stop")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text without the covered sentences, sentences, removed (their numbers, sorted)."""
    covered = stored(repeated_runs(docs, id_col, text_col).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "stop")).alias("gone"))
                     .withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"}), "covered", release=True)
    rows, schema = keyed(docs, id_col, text_col), "doc_id long, text string, sentences int, removed array<int>"
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t"))

    def count(batches):
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                found = Words(texts[lo:hi])
                total = np.bincount(found.text[found.stop], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(texts[lo:hi], pa.string()), pa.array(total.astype(np.int32)), pa.array([[]] * (hi - lo), pa.list_(pa.int32()))], ["doc_id", "text", "sentences", "removed"])

    def drop(batches):
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                out, total, removed = [], [], []
                for (data, start, end), gone in zip(sentence_bytes(texts[lo:hi]), b.column(2)[lo:hi].to_pylist()):
                    bad = sorted({k for g in gone or () for k in range(g["place"], min(g["stop"], len(start)))})
                    kept, at = [], 0
                    for k in bad:  # a removed sentence takes the break after it along
                        kept.append(data[at:start[k]])
                        at = start[k + 1] if k + 1 < len(start) else end[k]
                    out.append(b"".join([*kept, data[at:]]) if bad else data)
                    total.append(len(start))
                    removed.append(bad)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(out, pa.binary()).cast(pa.string()), pa.array(total, pa.int32()), pa.array(removed, pa.list_(pa.int32()))], ["doc_id", "text", "sentences", "removed"])

    if covered.count() > BROADCAST_TEXTS:
        return rows.join(covered, same, "left").select("doc_id", "text", "gone").mapInArrow(drop, schema)
    ids = F.broadcast(covered.select("_d", "_t"))  # only texts that change are moved
    whole = rows.join(ids, same, "left_anti").select("doc_id", "text").mapInArrow(count, schema)
    changed = rows.join(ids, same, "left_semi").join(covered.hint("merge"), same).select("doc_id", "text", "gone").mapInArrow(drop, schema)
    return whole.union(changed)
