"""Quality scores by Bradley-Terry ranking of document features.

Preference pairs join a document marked good with one marked bad; the strength
of a document is a weighted sum of its features, and the logistic loss on the
feature differences of the pairs gives the weights (Newton steps).  The
threshold is the quantile of the training strengths at the share of bad
documents; a document's score is the logistic function of its strength above
the threshold, so that 0.5 is the threshold.

The fit uses every labelled document, each in several pairs; features and
scores cover every whole text.  Null text is the empty text, whose features are all 0.  Without labels of both kinds
every score is 0.5.  Every input row gives one output row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from custos.llm.common import at_ranks, stored, text_bytes

ONE_MATCH = 200_000  # pairs
SEATS, OPPONENTS = 64, 16  # documents of a match, by label
RIDGE = 1e-3
FEATURES = ("bytes_log", "words_log", "lines_log", "upper", "digit", "space", "period", "comma", "bang_question", "quote", "bracket", "bar", "hash_dollar", "percent_and", "other_mark", "non_ascii",
            "word_length", "long_words", "end_marked", "bare_marks", "distinct_words", "top_word", "distinct_lines", "repeated_bytes", "line_words", "stop_end", "bigram_distinct")
_SENTENCE_END = re.compile(rb"[.!?](?=\s|$)")

_CLASS = np.full(256, 14, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n\v\f", b".", b",", b"!?", b"\"'", b"()[]{}<>", b"|", b"#$", b"%&", b"*+/=@\\^_`~-:;"), 3):
    _CLASS[list(_chars)] = _i
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 16
_CLASS[128:] = 15


def features(data: bytes) -> np.ndarray:
    """Shape of one whole text: shares of byte classes, word, line and repetition statistics."""
    out = np.zeros(len(FEATURES))
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = np.bincount(_CLASS, counts, 17) / len(data)
    out[3:16] = share[3:16]
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    out[0], out[1], out[2] = np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines))
    if words:
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        seen: dict[bytes, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        out[16], out[17] = size.mean() / 10, (size > 14).mean()
        out[18] = sum(not (w[-1:].isalnum() or w[-1] > 127) for w in words) / n
        out[19] = sum(c for w, c in seen.items() if not (w.isalnum() or max(w) > 127) and not any(x > 47 for x in w)) / n
        out[20], out[21] = len(seen) / n, max(seen.values()) / n
        out[26] = len(set(zip(words, words[1:]))) / max(1, n - 1)
    if lines:
        distinct = set(lines)
        out[22], out[23] = len(distinct) / len(lines), 1 - sum(map(len, distinct)) / sum(map(len, lines))
        out[24] = np.log1p(len(words) / len(lines))
    out[25] = len(_SENTENCE_END.findall(data)) / max(1, len(words))
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.strength(x) - self.threshold).clip(-500, 500)))


def _sums(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``fn``'s vectors of ``size`` numbers, by task and then over the tasks."""
    def run(batches):
        total = sum(map(fn, batches), np.zeros(size))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int64()), pa.array(total)], ["i", "s"])

    return np.array([r["s"] for r in sorted(rows.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect())])


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def matches(rows: DataFrame, n: dict[int, int]) -> DataFrame:
    """Documents dealt to matches by hash: (``good``, ``bad``) lists of features; every good one of a match meets every bad one.

    Few documents meet in one match.  Else about ``SEATS`` of the commoner label meet about ``OPPONENTS`` of the rarer
    one, whose documents play in several matches, so that every document takes part whatever the shares.
    """
    rare = min(n, key=lambda k: (n[k], k))
    common = 1 - rare
    many, few = (1, 1) if n[0] * n[1] <= ONE_MATCH else (max(1, n[common] // SEATS), max(1, n[rare] // OPPONENTS))
    few = min(few, many)
    dealt = lambda parts: F.pmod(F.xxhash64("doc_id", "features"), F.lit(parts))
    a = rows.where(F.col("label") == common).withColumn("match", dealt(many))
    b = rows.where(F.col("label") == rare).withColumn("match", F.explode(F.sequence(dealt(few), F.lit(many - 1).cast("long"), F.lit(few).cast("long"))))
    # in the order of their ids: sums of doubles do not depend on the shuffle
    seat = F.array_sort(F.collect_list(F.struct("label", "doc_id", "features")))
    of = lambda k: F.flatten(F.transform(F.filter("seats", lambda s: s["label"] == k), lambda s: s["features"]))
    return a.unionByName(b).groupBy("match").agg(seat.alias("seats")).select(of(1).alias("good"), of(0).alias("bad"))


def bradley_terry(rows: DataFrame, n: dict[int, int]) -> Model:
    """Weights from preference pairs (good over bad) in which every document of ``rows`` takes part.

    ``rows``: (doc_id, label, features), ``n`` documents per label.  Moments, gradients and curvatures are summed in
    the tasks; the threshold is the exact quantile of all strengths at the share of bad documents.
    """
    k, total = len(FEATURES), n[0] + n[1]
    mean = _sums(rows, lambda b: _matrix(b.column("features")).sum(0), k) / total
    scale = np.sqrt(_sums(rows, lambda b: ((_matrix(b.column("features")) - mean) ** 2).sum(0), k) / total)
    scale[scale < 1e-9] = 1
    model = Model(mean, scale, np.zeros(k), 0.0)
    games = stored(matches(rows, n), "quality_matches")
    w = model.weights
    for _ in range(30):
        def slopes(b, w=w):
            out = np.zeros(1 + k + k * k)
            for good, bad in zip(b.column("good"), b.column("bad")):
                g, h = (((x.values.to_numpy(zero_copy_only=False).reshape(-1, k) - mean) / scale).clip(-8, 8) for x in (good, bad))
                d = (g[:, None] - h[None]).reshape(-1, k)
                p = 1 / (1 + np.exp(-(d @ w).clip(-500, 500)))
                out += np.concatenate([[len(d)], d.T @ (1 - p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
            return out
        got = _sums(games, slopes, 1 + k + k * k)
        if not got[0]:
            return model
        step = np.linalg.solve(got[1 + k:].reshape(k, k) / got[0] + RIDGE * np.eye(k), got[1:1 + k] / got[0] - RIDGE * w)
        w = w + step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w

    def strengths(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.strength(_matrix(b.column("features"))))], ["s"])

    at = min(n[0] - 1, total - 2)
    model.threshold = float(np.mean(at_ranks(stored(rows.select("features").mapInArrow(strengths, "s double"), "quality_strengths"), "s", [at, at + 1], total)))
    return model


def fit(docs: DataFrame, labels: DataFrame, usable: Callable[[Column], Column], label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on every labelled document; without documents of both labels there are no weights and every score is 0.5.

    ``usable`` maps the id column to the rows whose labels may be learned from.
    """
    marks = labels.where(labels[label_col].isin(0, 1) & usable(labels[id_col])).select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_label"))
    # features meet their labels, by shuffle at every size: no text is moved
    found = with_features(docs.where(usable(docs[id_col])), id_col, text_col)
    rows = stored(found.join(marks.hint("merge"), found["doc_id"] == marks["_id"].cast("long")).select("doc_id", F.col("_label").alias("label"), "features"), "quality_features")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(n) < 2:
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0)
    return bradley_terry(rows, n)


def with_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(t) for t in text_bytes(b.column(1))], pa.list_(pa.float64()))], ["doc_id", "features"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "doc_id long, features array<double>")


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``strength``, ``score`` and ``predicted`` (1 at or above the threshold) per row."""
    names = ["doc_id", "strength", "score", "predicted"]

    def run(batches):
        for b in batches:
            x = np.array([features(t) for t in text_bytes(b.column(1))]).reshape(-1, len(FEATURES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.strength(x)), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, strength double, score double, predicted int")
