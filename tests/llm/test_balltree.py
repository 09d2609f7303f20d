"""Ball-tree search against all products."""

import numpy as np

from custos.llm import balltree

SCHEMA = "vec_id long, embedding array<float>, rank int, score long, shard int"


def brute(rows, k, every):
    ok = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def run(spark, rows, k=5, every=10, **how):
    df = balltree.top_k(spark.createDataFrame(rows, SCHEMA), lambda i: i % every == 0, k, **how)
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_equals_all_products(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 16))
    x = centres[rng.integers(0, 6, 900)] + 0.1 * rng.standard_normal((900, 16))
    x[100:300] = x[100]
    rows = [(i, v.tolist(), 1, 2, 3) for i, v in enumerate(x)]
    assert run(spark, rows, shard_rows=200, query_block=30) == brute(rows, 5, 10)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (10, [1.0, None]), (20, None), (30, [float("nan"), 1.0]), (40, [float("inf"), 0.0]), (50, []), (60, [-1.5, 0.3]), (3, [0.0, 0.0]), (None, [1.0, 1.0])]
    rows = [(*r, 0, 0, 0) for r in rows]
    assert run(spark, rows) == brute(rows, 5, 10)
    assert run(spark, []) == set()
    assert run(spark, rows[:1]) == set()


def test_whole_table(spark):
    from tests.conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = {tuple(r) for r in balltree.top_k(df, lambda i: i % 50 == 0, 5).collect()}
    assert got == brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 5, 50)
