"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from custos.session import ensure_checkpoint_dir

EMPTY_TEXT = ""
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, release: bool = False, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage at a result that is used more than once, so that a lost
    executor costs a re-read and not a re-computation.  Spark deletes the shuffle
    files of the write when it ends (they serve no other query).  ``release`` lets the
    driver collect its garbage as well, upon which Spark's cleaner deletes those of
    other finished queries (otherwise it may wait for half an hour).  Python steps
    get at most ``batch_rows`` rows at once: whole texts are held on both sides.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, tag)
    wanted = {SHUFFLE_CLEANUP: "true"} | ({} if batch_rows is None else {ARROW_ROWS: str(batch_rows)})
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    if release:
        spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored``; nothing that is still to be computed may read them."""
    for t in tables:
        where = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bounded_sample(rows: DataFrame, group: str, key: Column, limit: int, counts: dict) -> DataFrame:
    """At most ``limit`` rows of each group, the first by the hash of ``key``.

    ``counts`` holds the rows of each group.  Large groups are thinned by hash
    to about twice the limit where the rows lie, so that ranking them moves a
    bounded number of rows.
    """
    h = F.xxhash64(key)
    share = F.create_map(*(F.lit(x) for g, n in counts.items() for x in (g, int(min(1.0, 2 * limit / n) * 2 ** 30)))) if counts else F.lit(None)
    few = rows.where(F.shiftrightunsigned(h, 34) < share[F.col(group)]) if counts else rows.limit(0)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(h, key))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def at_ranks(rows: DataFrame, col: str, ranks: list[int], n: int) -> list[float]:
    """Exact values at neighbouring 0-based ``ranks`` of the ``n`` non-null values of ``col``.

    Two approximate quantiles bound a narrow range around the ranks; the values below are counted, and only the
    distinct values within reach the driver.  The range is widened until the ranks lie in it.
    """
    share = 1e-4
    while True:
        ends = [max(0.0, min(ranks) / n - share), min(1.0, (max(ranks) + 1) / n + share)]
        lo, hi = rows.agg(F.percentile_approx(col, ends, F.lit(int(2 / share)))).first()[0]
        lo, hi = lo if ends[0] else float("-inf"), hi if ends[1] < 1 else float("inf")
        below = rows.where(F.col(col) < lo).count()
        near = sorted(rows.where(F.col(col).between(lo, hi)).groupBy(col).count().collect())
        after = below + np.cumsum([r["count"] for r in near], dtype=np.int64)
        if below <= min(ranks) and len(near) and max(ranks) < after[-1]:
            return [near[int(np.searchsorted(after, r, side="right"))][0] for r in ranks]
        share *= 8


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [b"" if v is None else v for v in col.cast(pa.large_binary()).to_pylist()]


def slices(sizes, limit: int):
    """Consecutive (start, end) ranges whose summed size stays near ``limit``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def release_memory() -> None:
    """Give what a task has freed back to the machine: idle workers stay for the next stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class CodePoints:
    """Byte offsets of one UTF-8 text as code point offsets."""

    def __init__(self, data: bytes):
        self.before = None
        if not data.isascii():
            lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
            self.before = np.concatenate([[0], np.cumsum(lead)])

    def __call__(self, offset: int) -> int:
        return offset if self.before is None else int(self.before[offset])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public-domain constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
