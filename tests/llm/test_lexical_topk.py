"""Ranked search against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from custos.llm import lexical_topk
from tests.conftest import SF_SMALL
from tests.llm import cases

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) & c.keys())
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return out


def check(spark, docs, items, k=10):
    got = lexical_topk.top_k(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()], k)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    return want


def test_whole_table(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    check(spark, docs, items)
    monkeypatch.setattr(lexical_topk, "BLOCK_TERMS", 60)
    check(spark, docs, items, 3)


def test_edges(spark):
    docs = cases.docs(spark)
    rows = [(1, "Two words on one chapter, é and floods"), (1, "Two words on one chapter, é and floods"), (1, "another text of that id: words"), (2, None), (None, "villages moved uphill"), (None, "token"),
            (3, "...!"), (4, "nothinghere zzz"), (5, "one"), (6, cases.LONG), (7, "É ΣΑΣ ſ")]
    items = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "item_id long, text string, score double, rank int")
    assert check(spark, docs, items)
    assert lexical_topk.top_k(cases.docs(spark, []), items).count() == 0
    assert lexical_topk.top_k(docs, items.limit(0)).count() == 0
    assert lexical_topk.top_k(docs, items.where("item_id in (2, 3)")).count() == 0


def random_corpus(seed, n=3000, words=60):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, words + 1)
    text = lambda size: " ".join(f"w{x}" for x in rng.choice(words, size, p=p / p.sum()))
    docs = [(int(i), text(rng.integers(1, 40))) for i in rng.permutation(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(300)]  # ties
    return docs, [(i, text(rng.integers(1, 14))) for i in range(40)]


@pytest.mark.parametrize("seed", range(2))
def test_many_shards(spark, monkeypatch, seed):
    docs, items = random_corpus(seed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        monkeypatch.setattr(lexical_topk, "SHARD_DOCS", 500)
        check(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pair_bounds_hold_and_are_tighter():
    rng = np.random.default_rng(1)
    width, n = 6, 400
    held = rng.random((n, width)) < 0.4
    doc, term = np.nonzero(held)
    import pyarrow as pa
    impact = rng.integers(1, 1000, len(doc))
    shard = lexical_topk.Shard(pa.array(np.arange(n)), doc, term, impact, width, [(0, 1), (2, 3)])
    dense = np.zeros((n, width), np.int64)
    dense[doc, term] = impact
    for (a, b), (docs, joint, bound, alone) in shard.pairs.items():
        both = (dense[:, a] > 0) & (dense[:, b] > 0)
        assert docs.tolist() == np.flatnonzero(both).tolist() and joint.tolist() == (dense[both, a] + dense[both, b]).tolist()
        assert bound == (dense[:, a] + dense[:, b]).max() <= dense[:, a].max() + dense[:, b].max()
        assert alone == (dense[:, a] + dense[:, b])[~both].max()
    for floor in (0, 1500, 2500):
        place, score, _ = shard.search([(0, 1), (2, 3)], [4, 5], 7, floor)
        total = dense.sum(axis=1)
        want = sorted(((-s, i) for i, s in enumerate(total.tolist()) if s >= max(floor, 1)))[:7]
        assert [(-s, i) for i, s in zip(place.tolist(), score.tolist())] == want
