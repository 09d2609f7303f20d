"""Containment of benchmark items against all pairs."""

import re

from custos.llm import decontamination
from tests.llm import cases

ITEMS = "item_id long, text string, hash long, w string"


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def cut(w, n):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, percent):
    out = set()
    for j, t in items:
        w = words(t)
        s = cut(w, min(5, len(w))) if w else set()
        for i, d in docs:
            shared = len(s & cut(words(d), min(5, len(w)))) if s else 0
            if s and shared * 100 >= percent * len(s):
                out.add((i, j, shared, len(s)))
    return out


def run(spark, docs, items, **how):
    got = decontamination.contained(docs, spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS), **how)
    return {tuple(r) for r in got.select("doc_id", "item_id", "shared", "item_shingles").collect()}


def test_equals_all_pairs(spark, monkeypatch):
    base = [f"item{k} word{i}" for k in range(6) for i in range(12)]
    items = [(k, " ".join(base[12 * k:12 * k + 12])) for k in range(6)] + [(7, "two words"), (8, "one"), (9, None), (10, " .. "), (7, "two words")]
    texts = [cases.LONG + " " + items[0][1], items[1][1].replace("word5", "other"), " ".join(items[2][1].split()[:20]), " ".join(items[3][1].split()[:17]),
             items[4][1].upper().replace(" ", "*** | "), "say two, words now", None, "", "unrelated text of one kind"]
    docs = cases.plain(spark, [*texts, texts[1]])
    for percent in (80, 50, 100):
        want = brute(list(enumerate([*texts, texts[1]])), items, percent)
        assert run(spark, docs, items, percent=percent) == want
    monkeypatch.setattr(decontamination, "BROADCAST_HASHES", 0)
    assert run(spark, docs, items) == brute(list(enumerate([*texts, texts[1]])), items, 80)


def test_edges(spark):
    docs = cases.docs(spark)
    items = [(1, cases.SHARED), (2, "a row without an id has a text too")]
    got = run(spark, docs, items)
    assert {(i, j) for i, j, *_ in got} == {(10, 1), (11, 1), (None, 2)}
    assert run(spark, cases.docs(spark, []), items) == run(spark, docs, []) == set()
    left = decontamination.remove_contaminated(docs, spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS))
    assert left.columns == docs.columns and left.count() == len(cases.rows()) - 5
