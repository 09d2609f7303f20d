"""Language identification: a bidirectional gated recurrent network over bytes.

The text's UTF-8 bytes are read in windows of ``WINDOW`` positions (every
position of the whole text is in exactly one window; the state starts anew in
each).  A gated recurrent unit reads a window forwards, another backwards;
every position gets label probabilities from both states, and a document's
probabilities are the mean over all its positions.

Training is numpy back-propagation through time with Adam on windows of a
bounded sample: at most ``DOCS_PER_LABEL`` labelled documents per label (by
hash order of the id) and ``WINDOWS_PER_DOC`` windows from all over each.

Null text, or text without a letter: ``und`` with score 0.  Without any
labelled row every text is ``und``.  Every input row gives one output row; a
null id stays null; a null label is not learned from.  Equally likely labels: the
first by name.  Repeated rows give equal rows (and count as often when learned
from); very long texts are read whole; other columns, whatever their names, are
not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from custos.llm.common import at_ranks, bounded_sample, release_memory, slices, stored, text_bytes

WINDOW = 64
HIDDEN = 8
DOCS_PER_LABEL = 400
WINDOWS_PER_DOC = 6
STEPS = 300
BATCH = 256
BLOCK_BYTES = 1 << 19
FLOOR_QUANTILE = 0.001
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_PAD = 256


@dataclass
class Model:
    labels: list[str]
    params: dict[str, np.ndarray]
    seen: bytes = b""  # the byte values of the training windows


def _direction(x: np.ndarray, p: dict, d: str) -> tuple[np.ndarray, list]:
    """States (T, B, H) of one direction over byte ids x (T, B), and what the backward pass needs."""
    t_, b_ = x.shape
    h_ = p["U" + d].shape[0]
    h = np.zeros((b_, h_), np.float32)
    states, kept = np.empty((t_, b_, h_), np.float32), [None] * t_
    for t in range(t_) if d == "f" else range(t_ - 1, -1, -1):
        xw, hu = p["E" + d][x[t]], h @ p["U" + d]
        gates = 0.5 + 0.5 * np.tanh(0.5 * (xw[:, :2 * h_] + hu[:, :2 * h_]))
        r, z = gates[:, :h_], gates[:, h_:]
        c = np.tanh(xw[:, 2 * h_:] + r * hu[:, 2 * h_:])
        kept[t] = (h, hu[:, 2 * h_:], r, z, c)
        h = c + z * (h - c)
        states[t] = h
    return states, kept


def _backward(x, p, d, kept, ds, grad) -> None:
    """Adds one direction's gradients; ds: of its states (T, B, H)."""
    t_, b_ = x.shape
    h_ = p["U" + d].shape[0]
    ge, gu, carry = grad["E" + d], grad["U" + d], np.zeros((b_, h_), np.float32)
    for t in range(t_ - 1, -1, -1) if d == "f" else range(t_):
        h, hc, r, z, c = kept[t]
        g = ds[t] + carry
        dc = g * (1 - z) * (1 - c * c)
        dz = g * (h - c) * z * (1 - z)
        dr = dc * hc * r * (1 - r)
        dx = np.concatenate([dr, dz, dc], 1)
        dh = np.concatenate([dr, dz, dc * r], 1)
        np.add.at(ge, x[t], dx)
        gu += h.T @ dh
        carry = g * z + dh @ p["U" + d].T


def train(windows: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Fit by BPTT on labelled windows; every non-padding position is a labelled example."""
    names = sorted(set(labels))
    rng, k, h = np.random.default_rng(seed), len(names), HIDDEN
    x = np.full((len(windows), WINDOW), _PAD, np.int64)
    for i, w in enumerate(windows):
        x[i, :len(w)] = np.frombuffer(w[:WINDOW], np.uint8)
    y = np.searchsorted(names, labels)
    by_label = [np.flatnonzero(y == c) for c in range(k)]
    scale = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    p = {"Ef": scale(257, 3 * h), "Eb": scale(257, 3 * h), "Uf": scale(h, 3 * h), "Ub": scale(h, 3 * h), "W": scale(2 * h, k), "b": np.zeros(k, np.float32)}
    m1, m2 = ({n: np.zeros_like(v) for n, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(ix, -(-BATCH // k)) for ix in by_label])
        xb, yb = x[pick].T, y[pick]
        valid = (xb != _PAD).astype(np.float32)[..., None]
        (sf, kf), (sb, kb) = _direction(xb, p, "f"), _direction(xb, p, "b")
        s = np.concatenate([sf, sb], 2)
        logits = s @ p["W"] + p["b"]
        e = np.exp(logits - logits.max(2, keepdims=True))
        dl = e / e.sum(2, keepdims=True)
        dl[:, np.arange(len(yb)), yb] -= 1
        dl *= valid / valid.sum()
        grad = {n: np.zeros_like(v) for n, v in p.items()}
        grad["W"] += np.tensordot(s, dl, ([0, 1], [0, 1]))
        grad["b"] += dl.sum((0, 1))
        ds = dl @ p["W"].T
        _backward(xb, p, "f", kf, ds[..., :h], grad)
        _backward(xb, p, "b", kb, ds[..., h:], grad)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grad.items():
            g *= min(1.0, 1 / (norm + 1e-9))
            m1[n] += 0.1 * (g - m1[n])
            m2[n] += 0.01 * (g * g - m2[n])
            p[n] -= rate * (m1[n] / (1 - 0.9 ** step)) / (np.sqrt(m2[n] / (1 - 0.99 ** step)) + 1e-8)
    return Model(names, p)


def _scan(x: np.ndarray, p: dict, d: str) -> np.ndarray:
    """As ``_direction``, for scoring: writes in place, keeps only the label scores (T, B, K)."""
    t_, b_ = x.shape
    h_, w = p["U" + d].shape[0], p["W" + d]
    h, out = np.zeros((b_, h_), np.float32), np.empty((t_, b_, w.shape[1]), np.float32)
    for t in range(t_) if d == "f" else range(t_ - 1, -1, -1):
        g, hu = np.take(p["E" + d], x[t], axis=0), h @ p["U" + d]
        g[:, :2 * h_] += hu[:, :2 * h_]
        gates = np.tanh(g[:, :2 * h_])
        gates += 1
        gates *= 0.5
        c = hu[:, 2 * h_:]
        c *= gates[:, :h_]
        c += g[:, 2 * h_:]
        np.tanh(c, out=c)
        h -= c
        h *= gates[:, h_:]
        h += c
        np.matmul(h, w, out=out[t])
    return out


def _for_scoring(model: Model) -> dict:
    """Parameters with the gates' factor one half folded in and the output matrix split by direction."""
    h = model.params["Uf"].shape[0]
    p = {n: v.copy() for n, v in model.params.items()}
    for n in ("Ef", "Eb", "Uf", "Ub"):
        p[n][:, :2 * h] *= 0.5
    p["Wf"], p["Wb"] = np.ascontiguousarray(p["W"][:h]), np.ascontiguousarray(p["W"][h:])
    return p


def probabilities(texts: list[bytes], model: Model, params: dict | None = None) -> np.ndarray:
    """Mean label probabilities over all byte positions of each text (0 for the empty text)."""
    out = np.zeros((len(texts), len(model.labels)))
    if not model.labels:
        return out
    p = params or _for_scoring(model)
    for lo, hi in slices([len(t) for t in texts], BLOCK_BYTES):
        part = texts[lo:hi]
        data = np.frombuffer(b"".join(part), np.uint8)
        n = np.array([len(t) for t in part])
        rows = -(-n // WINDOW)
        first = np.concatenate([[0], np.cumsum(rows)])
        if not first[-1]:
            continue
        x = np.full(first[-1] * WINDOW, _PAD, np.int16)
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        x[np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - begin, n)] = data
        doc = np.repeat(np.arange(len(part)), rows)
        for a in range(0, len(doc), 4096):
            xb = np.ascontiguousarray(x[a * WINDOW:(a + 4096) * WINDOW].reshape(-1, WINDOW).T)
            e = _scan(xb, p, "f")
            e += _scan(xb, p, "b")
            e += p["b"]
            np.exp(np.clip(e, -30, 30, out=e), out=e)
            e *= ((xb != _PAD) / e.sum(2))[..., None]
            np.add.at(out, lo + doc[a:a + 4096], e.sum(0))
        out[lo:hi] /= np.maximum(n, 1)[:, None]
    return out


def sample_windows(docs: DataFrame, usable: Callable[[Column], Column], id_col: str, text_col: str, label_col: str) -> tuple[list[bytes], list[str]]:
    """Windows of the bounded training sample, evenly spread over whole texts."""
    lang, text = docs[label_col].cast("string"), F.col("text")
    mine = docs.where(usable(docs[id_col]) & lang.isNotNull())
    counts = {r["label"]: r["count"] for r in mine.groupBy(lang.alias("label")).count().collect()}
    at = lambda i: (i * F.greatest(F.length(text) - WINDOW, F.lit(0)) / (WINDOWS_PER_DOC - 1)).cast("int") + 1
    windows = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1)), lambda i: F.substring(text, at(i), F.lit(WINDOW)))
    rows = bounded_sample(mine.select(lang.alias("label"), docs[id_col].alias("id"), text.alias("text")), "label", F.col("id"), DOCS_PER_LABEL, counts)
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    got = sorted(rows.select("label", windows.alias("windows")).collect())
    pairs = [(w.encode()[:WINDOW], r["label"]) for r in got for w in dict.fromkeys(r["windows"]) if w]
    return [w for w, _ in pairs], [label for _, label in pairs]


def fit(docs: DataFrame, usable: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """Train on the bounded sample; ``usable`` maps the id column to the rows that may be learned from."""
    windows, labels = sample_windows(docs, usable, id_col, text_col, label_col)
    if not windows:
        return Model([], {})
    model = train(windows, labels)
    model.seen = bytes(sorted(set(b"".join(windows))))
    return model


def score_floor(docs: DataFrame, model: Model, usable: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> float:
    """The ``FLOOR_QUANTILE`` of the scores of all correctly labelled whole texts, a tenth off; 0 without any."""
    if not model.labels:
        return 0.0
    label = docs[label_col].cast("string")
    mine = docs.where(usable(docs[id_col]) & label.isNotNull()).select(docs[text_col].cast("string").alias("text"), label.alias("label"))

    def run(batches):
        params = _for_scoring(model)
        for b in batches:
            texts = [t if _LETTER.search(t.decode()) else b"" for t in text_bytes(b.column(0))]
            for lo, hi in slices([len(t) for t in texts], BLOCK_BYTES):
                probs = probabilities(texts[lo:hi], model, params)
                right = [bool(t) and model.labels[j] == y for t, j, y in zip(texts[lo:hi], probs.argmax(1), b.column(1)[lo:hi].to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(1.0, probs.max(1)[right]))], ["score"])
        release_memory()

    scores = stored(mine.mapInArrow(run, "score double"), "language_scores")
    n = scores.count()
    if not n:
        return 0.0
    place = FLOOR_QUANTILE * (n - 1)
    low, high = at_ranks(scores, "score", [int(place), min(int(place) + 1, n - 1)], n)
    return 0.9 * (low + (place - int(place)) * (high - low))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (its pooled probability) and ``probs`` (by learned label) per row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("probs", pa.list_(pa.float64()))])

    def run(batches):
        params = _for_scoring(model) if model.labels else {}
        for b in batches:
            texts = [t if _LETTER.search(t.decode()) else b"" for t in text_bytes(b.column(1))]
            probs = probabilities(texts, model, params)
            best = probs.argmax(1) if model.labels else np.zeros(len(texts), int)
            known = [bool(t and model.labels) for t in texts]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([model.labels[j] if k else UNDETERMINED for j, k in zip(best, known)]),
                pa.array([min(1.0, float(q[j])) if k else 0.0 for q, j, k in zip(probs, best, known)], pa.float64()), pa.array(list(probs), schema.field(3).type)], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, probs array<double>")


def strange(data: bytes, unseen: bytes) -> bool:
    """Whether more than half of the letters are spelled with bytes among ``unseen``."""
    if len(data.translate(None, unseen)) == len(data):
        return False
    letters, odd = _LETTER.findall(data.decode()), frozenset(unseen)
    return 2 * sum(not odd.isdisjoint(c.encode()) for c in letters) > len(letters)


def keep_identified(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (all columns) whose language is known with at least ``min_score``.

    Texts without a letter go, and texts most of whose letters are spelled with
    bytes that no training text had (another script).  Only the texts pass
    through Python, a few megabytes at a time.
    """
    unseen = bytes(b for b in range(256) if b not in set(model.seen))

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        params, out = _for_scoring(model) if model.labels else {}, np.zeros(len(texts), bool)
        data = [t if _LETTER.search(t.decode()) else b"" for t in text_bytes(texts)]
        for lo, hi in slices([len(t) for t in data], BLOCK_BYTES):
            best = probabilities(data[lo:hi], model, params).max(1, initial=0.0)
            for i, t in enumerate(data[lo:hi]):
                out[lo + i] = bool(t) and best[i] >= min_score and not strange(t, unseen)
        release_memory()
        return pa.array(out)

    return docs.where(known(docs[text_col].cast("string")))
