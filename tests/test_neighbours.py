"""Nearest neighbours by cells: exact, each query meets few points."""

import numpy as np
import pytest

from custos.operators import ml, neighbours


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 40)


def frame(spark, rows, name, d):
    return spark.createDataFrame([(int(i), *map(float, v)) for i, v in rows], f"{name} int, " + ", ".join(f"c{k} double" for k in range(d)))


@pytest.mark.parametrize("d", [1, 3])
def test_distances_equal_brute_force(spark, small_cells, d):
    rng = np.random.default_rng(d)
    c = np.vstack([rng.random((500, d)), rng.random((60, d)) * 0.01 + 5, np.repeat(rng.integers(0, 3, (40, d)), 2, axis=0)])
    q = np.vstack([rng.random((60, d)) * 7 - 1, c[::9]])
    cols = [f"c{k}" for k in range(d)]
    got = {r["q"]: r["nn_distance"] for r in ml.nearest_distance(frame(spark, enumerate(q), "q", d), frame(spark, enumerate(c), "c", d), cols, "q", max_queries=20).collect()}
    want = np.sqrt(((q[:, None] - c[None]) ** 2).sum(2)).min(1)
    assert np.allclose([got[i] for i in range(len(q))], want)
    ids = np.arange(0, len(c), 7)
    got = {r["q"]: r["nn_distance"] for r in ml.nearest_distance(frame(spark, ((i, c[i]) for i in ids), "q", d), frame(spark, enumerate(c), "c", d), cols, "q", "c").collect()}
    d2 = ((c[ids][:, None] - c[None]) ** 2).sum(2)
    d2[np.arange(len(ids)), ids] = np.inf  # its own row does not count, another at the same place does
    assert np.allclose([got[i] for i in ids], np.sqrt(d2.min(1)))


def test_a_query_meets_few_points(spark, small_cells):
    rng = np.random.default_rng(2)
    x = rng.random((4000, 2))
    tree = neighbours.CellTree(x, 60)
    own = tree.cell(x)
    assert 50 <= len(tree.low) and np.bincount(own).max() <= 100 and ((tree.low[own] <= x) & (x <= tree.high[own])).all()
    assert np.bincount(tree.within(x, np.full(len(x), 0.02 ** 2))[0]).max() <= 6


def test_nulls_and_no_corpus(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0), (2, None, 1.0), (3, 3.0, 5.0)], "i int, c0 double, c1 double")
    got = {r["i"]: r["nn_distance"] for r in ml.nearest_distance(rows, rows, ["c0", "c1"], "i", "i").collect()}
    assert got[1] == got[3] == 5.0 and np.isnan(got[2])
    assert ml.nearest_distance(rows, rows.where("false"), ["c0", "c1"], "i").count() == 0
