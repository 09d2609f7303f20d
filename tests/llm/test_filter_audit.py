"""Filter interactions against filters applied one after another."""

import itertools
import re

import numpy as np

from custos.llm import filter_audit
from tests.conftest import SF_SMALL
from tests.llm import cases


def brute(docs, labels):
    """docs: (id, text, source); labels: (id, quality, toxic)."""
    good, toxic, first = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = []
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and i > first[t]]
        rows.append((s or "", "".join(f for f, x in zip("ABCDE", fails) if x), i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part in {r[0] for r in rows}:
        mine, share = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                share[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == f for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for key, v in out.items():
            if key[0] == part:
                v[6] = share[v[6]] if isinstance(v[6], str) else v[6]
    return {k: tuple(v) for k, v in out.items()}


def check(spark, docs, labels):
    got = filter_audit.audit(filter_audit.mask_counts(docs, labels)).collect()
    want = brute([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in got} == want
    assert len(got) == len(want)


def test_whole_table(spark):
    check(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))


def test_edges(spark):
    rows = cases.rows()
    rows += [(300 + i, t, None, s, None, *rows[0][5:]) for i, (t, s) in enumerate([(None, None), ("", ""), ("ABC # d", "s"), ("ABC # d", None), (" ".join(f"w{i}" for i in range(50)), "s"), ("a b " * 30, "t"), ("\x0b\x1c   É", "t")])]
    rows += [(None, "ABC # d", None, "s", None, *rows[0][5:]), rows[-1]]
    labels = spark.createDataFrame([(300, 1, 0), (301, 0, 1), (302, 1, 1), (302, 0, 0), (303, None, 1), (None, 1, 1), (10, 1, None)], "doc_id long, quality int, toxic int")
    check(spark, cases.docs(spark, rows), labels)
    check(spark, cases.docs(spark, rows), labels.limit(0))
    assert filter_audit.audit(filter_audit.mask_counts(cases.docs(spark, []), labels)).count() == 0


def test_many_copies_over_many_parts(spark):
    rows = [(i, f"copy {i % 3}", f"s{i % 40}") for i in range(2000)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([(i, i % 2, i % 5) for i in range(2000)], "doc_id long, quality int, toxic int"))


def test_removal_ranks_are_the_first_failing_step():
    perm, position = filter_audit.orders(4)
    masks = np.arange(16)
    rank = filter_audit.removal_ranks(masks, position)
    for m in masks:
        for o, p in enumerate(perm):
            steps = [s for s, f in enumerate(p) if m >> f & 1]
            assert rank[m, o] == steps[0] if steps else rank[m, o] >= filter_audit.NEVER
