"""The n-gram Jaccard join against all pairs."""

import os
import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from custos.llm import common, jaccard_join
from tests.conftest import SF_SMALL
from tests.llm import cases


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(texts, n, percent):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df, n, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df, n, percent).collect()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent", "seed", "hot"), [(3, 90, 1, 50), (5, 80, 2, 50), (2, 80, 3, 2), (3, 80, 4, 2), (3, 90, 5, 3)])
def test_random_groups_equal_all_pairs(spark, monkeypatch, n, percent, seed, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rng = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 12, 20, 60, 150]))]
        if rng.random() < 0.5:
            base = passage + base
        for _ in range(rng.randrange(1, 14)):
            texts.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 12)))
    rng.shuffle(texts)
    assert got(cases.plain(spark, texts), n, percent) == brute(dict(enumerate(texts)), n, percent)


def test_whole_table_equals_all_pairs(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert got(df, 3, 90) == brute({r["doc_id"]: r["text"] for r in df.collect()}, 3, 90)


def test_edges(spark):
    out = jaccard_join.jaccard_components(cases.docs(spark), 3, 90).collect()
    assert len(out) == len(cases.rows())
    by = {r["doc_id"]: r for r in out}
    assert by[0]["n_shingles"] == by[2]["n_shingles"] == 0 and by[2]["component_id"] == 2
    assert by[4]["component_id"] == 3 and by[6]["component_id"] == 5 and by[9]["component_id"] == 8
    assert jaccard_join.jaccard_components(cases.docs(spark, []), 3, 90).count() == 0


def test_boundary_is_inclusive(spark):
    words = [f"w{i}" for i in range(19)]
    a, b = " ".join(words), " ".join(words[:18])
    assert got(cases.plain(spark, [a, b, " ".join(words[:17])]), 1, 90) == {0: (19, 0), 1: (18, 0), 2: (17, 0)}


def all_links(texts, n, percent):
    """Per text the number of other sets that its set links to."""
    sets = [shingles(t, n) for t in texts]
    unique = set(sets) - {frozenset()}
    linked = lambda a, b: a != b and 100 * len(a & b) >= percent * len(a | b)
    count = {a: sum(linked(a, b) for b in unique) for a in unique}
    return {i: count.get(s, 0) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 90, 1 << 19), (2, 80, 700)])
def test_links_are_counted_over_all_pairs(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_HASHES", block)
    rng = random.Random(7)
    texts = [None, "", "a b", "a b"]
    for size, copies in ((200, 60), (90, 25), (40, 2), (30, 3), (10, 6)):
        base = [f"w{rng.randrange(4000)}" for _ in range(size)]
        texts += [edited(rng, base, rng.randrange(0, 1 + size // 25)) for _ in range(copies)] + [" ".join(base)] * 2
    chain = [f"c{i}" for i in range(150)]
    texts += [" ".join(chain[4 * i:4 * i + 90]) for i in range(14)]  # neighbours link, the ends do not
    rng.shuffle(texts)
    out = jaccard_join.jaccard_components(cases.plain(spark, texts), n, percent).collect()
    want = all_links(texts, n, percent)
    assert {r["doc_id"]: r["n_links"] for r in out} == want
    assert max(want.values()) > 20


def test_one_id_with_several_texts(spark):
    rng = random.Random(4)
    a, b = ([f"{k}{rng.randrange(5000)}" for _ in range(60)] for k in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*b, "more"])), (3, " ".join([*a, "other"])), (0, "something else entirely here now"), (1, None), (3, " ".join([*a, "other"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rows_out = jaccard_join.jaccard_components(df, 3, 90).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in rows_out) == [(0, 3, 0, 0), (1, 0, 1, 0), (1, 58, 1, 1), (1, 58, 1, 1), (2, 59, 1, 1), (3, 59, 1, 1), (3, 59, 1, 1)]
    left = jaccard_join.without_near_duplicates(spark.createDataFrame([(5, " ".join(a)), (1, " ".join([*a, "x"])), (5, " ".join(b)), (7, "lone words stand here"), (7, "lone words stand here"), (None, " ".join(a))], "doc_id long, text string"), 3, 90)
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(1, " ".join([*a, "x"])), (5, " ".join(b)), (7, "lone words stand here"), (None, " ".join(a))], key=str)


def test_a_dense_group_without_a_good_star_verifies_few_pairs(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = {i: edited(rng, base, rng.choice([1, 2])) for i in range(600)}
    asked, plain = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *a: (asked.append(pairs.count()), plain(pairs, *a))[1])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got(df, 3, 90) == brute(texts, 3, 90)
    assert sum(asked) < 4 * len(texts), asked


def test_disk_is_given_back_while_the_join_goes_on(spark, monkeypatch):
    """Fragment keys, the largest table, are deleted once they have met; a finished write leaves no shuffle files."""
    left, plain = {}, jaccard_join.stored

    def seen(df, tag, *a, **k):
        out = plain(df, tag, *a, **k)
        path = out.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        left.setdefault(tag, []).append(path)
        return out

    monkeypatch.setattr(jaccard_join, "stored", seen)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = {i: edited(rng, base, rng.choice([1, 2])) for i in range(60)}
    assert got(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 90) == brute(texts, 3, 90)
    assert not any(os.path.exists(p) for tag in ("signatures", "shared_keys") for p in left[tag])
    assert all(os.path.exists(p) for p in left["links"])


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for d in dirs for f in Path(d.getPath()).rglob("shuffle_*.data")}


def test_stored_deletes_its_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(20000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    out = common.stored(df, "kept")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert {r["k"]: r["count"] for r in out.collect()} == {k: len(range(k, 20000, 7)) for k in range(7)}
    common.discard(out)
    assert not os.path.exists(out._stored_at.removeprefix("file://"))
