"""Exact top-k inner-product search with ball trees.

Candidates are dealt to shards of bounded size by a hash of their id.  Each
shard has a ball tree: nodes with a centre and a radius, split at the median of
the direction along which they spread most.  A block of queries walks the tree
best first: the node whose inner-product upper bound (centre product plus query
norm times radius) is highest comes next, with those queries of the block whose
current k-th score the bound can still reach; the rest are pruned.  Equal bounds
are kept, so ties are decided by id.

The k-th scores are shared: a first pass over one shard gives every query a
lower bound to begin with, and a task passes the scores it has reached on from
shard to shard.

Components are turned into integers (``floor(scale * x)``), so products are
exact in doubles.  Vectors that are null, empty, hold a null or non-finite
component, or have another length than the queries of a block take no part;
repeated rows are candidates each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from custos.llm.common import scratch_path, stored

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
LEAF = 64
BLOCKS_AT_ONCE = 8


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): integer vectors that take part."""
    v = vectors[vec_col].cast("array<double>")
    whole = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vectors.where(vectors[id_col].isNotNull() & whole).select(vectors[id_col].cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v"))


class BallTree:
    def __init__(self, x: np.ndarray, ids: np.ndarray):
        order = np.arange(len(x))
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        centres, radii = [], []

        def build(lo: int, hi: int) -> int:
            me, rows = len(self.nodes), order[lo:hi]
            c = x[rows].mean(0)
            self.nodes.append((lo, hi, -1, -1))
            centres.append(c)
            radii.append(np.sqrt(((x[rows] - c) ** 2).sum(1).max()))
            if hi - lo > LEAF and radii[me] > 0:
                far = x[rows[((x[rows] - c) ** 2).sum(1).argmax()]] - c
                mid = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(x[rows] @ far, mid)]
                left = build(lo, lo + mid)
                self.nodes[me] = (lo, hi, left, build(lo + mid, hi))
            return me

        build(0, len(x))
        self.x, self.ids, self.centres, self.radii = x[order], ids[order], np.array(centres), np.array(radii)

    def bounds(self, node: int, q: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of each query with any vector of the node."""
        b = q @ self.centres[node] + norms * self.radii[node]
        return b + 1e-9 * (np.abs(b) + norms * self.radii[node] + 1)

    def search(self, q: np.ndarray, qids: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[int, int, float]]:
        """Rows (query number, vec_id, score) that may be among the k best; raises ``floor`` (the k-th scores)."""
        norms = np.sqrt((q * q).sum(1))
        scores, ids = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        heap = [(-np.inf, 0, np.arange(len(q)), np.full(len(q), np.inf))]
        while heap:
            _, node, active, bound = heapq.heappop(heap)
            active = active[bound >= floor[active]]
            if not len(active):
                continue
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    b = self.bounds(child, q[active], norms[active])
                    if (b >= floor[active]).any():
                        heapq.heappush(heap, (-b.max(), child, active, b))
                continue
            s = q[active] @ self.x[lo:hi].T
            s[self.ids[lo:hi][None, :] == qids[active][:, None]] = -np.inf
            some = (s >= floor[active][:, None]).any(1)
            active, s = active[some], s[some]
            if len(active):
                all_s, all_i = np.concatenate([scores[active], s], 1), np.concatenate([ids[active], np.broadcast_to(self.ids[lo:hi], s.shape)], 1)
                best = np.lexsort((all_i, -all_s), 1)[:, :k]
                scores[active], ids[active] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)
                floor[active] = np.maximum(floor[active], scores[active, k - 1])
        at, rank = np.nonzero((scores > -np.inf) & (scores >= floor[:, None]))
        return list(zip(at.tolist(), ids[at, rank].tolist(), scores[at, rank].tolist()))


def shards_of(vectors: DataFrame, rows: int) -> DataFrame:
    """(shard, dim, ids, matrix): the rows of a stored table dealt into packed shards of about ``rows``."""
    n = max(1, -(-vectors.count() // rows))
    place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    dealt = vectors.select(F.size("v").alias("dim"), place.alias("shard"), "vec_id", "v")
    grouped = dealt.groupBy("shard", "dim").agg(F.array_sort(F.collect_list(F.struct("vec_id", "v"))).alias("rows"))

    def pack(batches):
        for b in batches:
            for shard, dim, one in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids, x = one.values.field("vec_id").to_numpy(), one.values.field("v").flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["shard", "dim", "ids", "matrix"])

    return grouped.mapInArrow(pack, "shard int, dim int, ids binary, matrix binary")


def _searched(batches, k: int):
    """For every row (a shard and a block of queries): the row, its queries' ids, the rows found and the k-th scores reached."""
    tree, tree_of, reached = None, None, {}
    for b in batches:
        for i in range(b.num_rows):
            r = {name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)}
            if tree_of != (r["shard"], r["dim"]):
                tree, tree_of = BallTree(np.frombuffer(r["matrix"]).reshape(-1, r["dim"]), np.frombuffer(r["ids"], np.int64)), (r["shard"], r["dim"])
            qids, q = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_matrix"]).reshape(-1, r["dim"])
            start = np.frombuffer(r["floors"]) if r["floors"] else np.full(len(q), -np.inf)
            floor = reached.setdefault((r["block"], r["dim"]), start.copy())
            yield r, qids, tree.search(q, qids, k, floor), floor


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query, ties to the smaller id.

    ``is_query`` maps the id column to the rows that are queries.  Blocks of
    queries are broadcast ``BLOCKS_AT_ONCE`` at a time and meet every shard once.
    """
    spark = vectors.sparkSession
    ints = stored(integer_vectors(vectors, scale, id_col, vec_col), "vectors")
    shards = stored(shards_of(ints, shard_rows), "shards")
    queries = stored(ints.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id"]), "queries")
    blocks = stored(shards_of(queries, query_block).withColumnsRenamed({"shard": "block", "ids": "q_ids", "matrix": "q_matrix"}), "blocks")

    def floors(batches):
        for r, _, _, floor in _searched(batches, k):
            yield pa.RecordBatch.from_arrays([pa.array([r["block"]], pa.int32()), pa.array([r["dim"]], pa.int32()), pa.array([floor.tobytes()], pa.binary())], ["block", "dim", "floors"])

    def rows(batches):
        for _, qids, found, _ in _searched(batches, k):
            if found:
                at, ids, scores = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(qids[list(at)]), pa.array(ids, pa.int64()), pa.array(np.array(scores).astype(np.int64))], ["query_id", "vec_id", "score"])

    n_shards, n_blocks = shards.count(), blocks.agg(F.max("block")).first()[0]
    tasks = max(1, min(n_shards, max(2 * spark.sparkContext.defaultParallelism, n_shards // 8)))
    path = scratch_path(spark, "found")
    for first in range(0, (n_blocks if n_blocks is not None else 0) + 1, BLOCKS_AT_ONCE):
        some = blocks.where(F.col("block").between(first, first + BLOCKS_AT_ONCE - 1))
        asked = F.broadcast(some.withColumn("floors", F.lit(None).cast("binary")))
        seed = shards.where("shard = 0").join(asked, "dim").mapInArrow(floors, "block int, dim int, floors binary")
        ready = stored(some.join(seed, ["block", "dim"], "left"), "ready")
        shards.repartition(tasks, "shard").join(F.broadcast(ready), "dim").mapInArrow(rows, "query_id long, vec_id long, score long").write.mode("append").parquet(path)
    found = spark.read.schema("query_id long, vec_id long, score long").parquet(path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
