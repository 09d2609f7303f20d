"""Exact nearest neighbours in cells.

The distinct points are cut into cells by a tree of medians, which is built on a bounded sample: the sample only
shapes the cells, every point is in one.  A query first meets the points of its own cell; the distance found there
bounds the other cells that can hold a nearer one, and only these are met in a second round.  What a task holds are
the points of one cell and a bounded number of its queries.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 2048  # points a cell, at least; with n points it grows as the root of n
SHAPE_ROWS = 16  # sampled points a cell that shape the tree
BLOCK = 1 << 21  # distances computed at a time


class CellTree:
    """Cells by medians: nodes (column, cut, children) and the closed box of every cell."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.column, self.cut, self.child, boxes = [], [], [], []
        d = sample.shape[1]

        def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, rows: float) -> int:
            """Number of the node; leaves are ~ their cell."""
            wide = np.ptp(x, axis=0) if len(x) else np.zeros(d)
            k = int(np.argmax(wide))
            if len(x) <= rows or not wide[k] > 0:
                boxes.append((low, high))
                return ~(len(boxes) - 1)
            cut = float(np.median(x[:, k]))
            if not (x[:, k] > cut).any():  # many equal ones at the top
                cut = float(x[x[:, k] < cut, k].max())
            node = len(self.column)
            self.column.append(k)
            self.cut.append(cut)
            self.child.append(None)
            left = x[:, k] <= cut
            up, down = high.copy(), low.copy()
            up[k] = down[k] = cut
            self.child[node] = grow(x[left], low, up, rows), grow(x[~left], down, high, rows)
            return node
        self.root = grow(sample, np.full(d, -np.inf), np.full(d, np.inf), max(len(sample) / max(cells, 1), 1))
        self.low, self.high = (np.array([b[i] for b in boxes]).reshape(len(boxes), d) for i in (0, 1))

    def cell(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root)
        column, cut = np.array(self.column, int), np.array(self.cut, float)
        child = np.array(self.child, int).reshape(-1, 2)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            right = x[inner, column[node]] > cut[node]
            at[inner] = child[node, right.astype(int)]
        return ~at

    def within(self, x: np.ndarray, d2: np.ndarray):
        """(row, cell) of the cells that hold or touch a point nearer than the square root of ``d2``."""
        rows, cells = [np.zeros(0, int)], [np.zeros(0, int)]
        step = max(BLOCK // max(len(self.low), 1), 1)
        for at in range(0, len(x), step):
            part = x[at:at + step]
            gap = np.zeros((len(part), len(self.low)))
            for k in range(x.shape[1]):
                v = part[:, k, None]
                gap += np.maximum(np.maximum(self.low[None, :, k] - v, v - self.high[None, :, k]), 0.0) ** 2
            r, c = np.nonzero(gap < d2[at:at + step, None])
            rows.append(r + at)
            cells.append(c)
        return np.concatenate(rows), np.concatenate(cells)


def _meet(key, asked: pd.DataFrame, points: pd.DataFrame, cols: list[str]) -> pd.DataFrame:
    """Least squared distance of each query to the points of a cell; a point that only the query's own row holds is left out."""
    out = np.full(len(asked), np.inf)
    if len(points):
        q, x = asked[cols].to_numpy(dtype="float64"), points[cols].to_numpy(dtype="float64")
        own, only = asked["_own"].to_numpy(), points["_only"].to_numpy()
        alone = points["_only"].notna().to_numpy()
        step = max(BLOCK // len(x), 1)
        for at in range(0, len(q), step):
            d2 = np.zeros((len(q[at:at + step]), len(x)))
            for k in range(len(cols)):
                d2 += (q[at:at + step, k, None] - x[None, :, k]) ** 2
            if alone.any():
                d2[(own[at:at + step, None] == only[None, :]) & alone[None, :]] = np.inf
            out[at:at + step] = d2.min(axis=1)
    return pd.DataFrame({"_q": asked["_q"], "_d2": out})


def nearest(queries: DataFrame, corpus: DataFrame, cols: list[str], qid: str, cid: str | None, most: int) -> DataFrame:
    """(qid, nn_distance) of every query; at most about ``most`` queries of a cell meet its points in one task."""
    spark = corpus.sparkSession
    num = [F.col(c).cast("double").alias(c) for c in cols]
    known = lambda df: df.where(" and ".join(f"{c} is not null and not isnan({c})" for c in cols))
    id_type = queries.schema[qid].dataType.simpleString()
    one = (F.col("_id") if cid else F.lit(None)).cast(id_type)
    only = F.when((F.min(one) == F.max(one)) & (F.count(one) == F.count("*")), F.min(one))
    points = (known(corpus.select(*([F.col(cid).alias("_id")] if cid else []), *num)).groupBy(*cols).agg(only.alias("_only")).persist())
    n = points.count()
    cells = max(n // max(CELL_ROWS, int(n ** 0.5)), 1)
    share = min(1.0, cells * SHAPE_ROWS / max(n, 1))
    sample = points.where(F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) < share * (1 << 20)).select(*cols).toPandas().to_numpy(dtype="float64")
    tree = CellTree(sample.reshape(-1, len(cols)), cells)
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def cell_of(*x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.cell(np.column_stack([v.to_numpy(dtype="float64") for v in x])))

    @F.pandas_udf("array<int>")
    def others(own: pd.Series, d2: pd.Series, *x: pd.Series) -> pd.Series:
        rows, found = shared.value.within(np.column_stack([v.to_numpy(dtype="float64") for v in x]), d2.to_numpy())
        keep = found != own.to_numpy()[rows]
        return pd.Series(np.split(found[keep], np.searchsorted(rows[keep], np.arange(1, len(own)))), dtype=object)
    asked = queries.select(F.col(qid).alias("_own"), F.monotonically_increasing_id().alias("_q"), *num).persist()  # numbered once
    asked.count()
    home = known(asked).withColumn("_cell", cell_of(*cols))
    placed = points.withColumn("_cell", cell_of(*cols))

    def met(rows: DataFrame) -> DataFrame:
        """Queries of a cell are dealt over parts of at most about ``most``; its points go to each part."""
        parts = rows.groupBy("_cell").agg(F.ceil(F.count("*") / most).cast("int").alias("_parts"))
        rows = rows.join(parts, "_cell").withColumn("_part", F.pmod(F.xxhash64("_q"), "_parts").cast("int"))
        copies = placed.join(parts, "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        return (rows.select("_cell", "_part", "_q", "_own", *cols).groupBy("_cell", "_part")
                    .cogroup(copies.select("_cell", "_part", "_only", *cols).groupBy("_cell", "_part"))
                    .applyInPandas(partial(_meet, cols=cols), "_q long, _d2 double"))
    first = home.join(met(home), "_q").persist()
    more = first.withColumn("_cell", F.explode(others("_cell", "_d2", *cols)))
    best = first.select("_q", "_d2").unionByName(met(more)).groupBy("_q").agg(F.min("_d2").alias("_d2"))
    some: Column = F.lit(bool(len(tree.low)) and n > 0)
    return (asked.join(best, "_q", "left").where(some)
                 .select(F.col("_own").alias(qid), F.coalesce(F.sqrt("_d2"), F.lit(float("nan"))).alias("nn_distance")))
