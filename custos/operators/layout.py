"""Parallel layouts for order-dependent work (H2).

An unpartitioned ``Window.orderBy`` runs on a single task.  Two helpers keep
such work parallel:

* ``prefix_sums``: exact running totals over a global order.  Rows are cut
  into ``buckets`` key ranges (boundaries from ``approxQuantile`` - only the
  boundary list, of size ``buckets``, reaches the driver), running sums are
  computed inside each bucket by a partitioned window, and each bucket is
  shifted by the total of the buckets before it (a ``buckets``-row table,
  broadcast - its size is bounded by the parameter, not by the data).
* ``halo_frames``: for a sliding frame of K preceding rows over one long
  series, rows get a dense index, are grouped in blocks of B, and the last K
  rows of each block are copied into the next block as a halo.  A window
  partitioned by (series, block) then sees every row it needs; halo rows are
  dropped afterwards.  Work per task is O(B + K).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket_expr(order_col: str, bounds: list) -> Column:
    expr = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        expr = F.when(F.col(order_col) < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def _as_number(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType.typeName()
    if t == "date":
        return F.unix_date(F.col(col)).cast("double")
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def range_buckets(df: DataFrame, order_col: str, buckets: int) -> tuple[DataFrame, int]:
    """Add ``_bkt``: a bucket id monotone in ``order_col`` (ties share a bucket)."""
    if buckets <= 1:
        return df.withColumn("_bkt", F.lit(0)), 1
    probs = [i / buckets for i in range(1, buckets)]
    num = df.select(_as_number(df, order_col).alias("_o")).where(F.col("_o").isNotNull())
    bounds = sorted(set(num.approxQuantile("_o", probs, 0.001)))
    tmp = df.withColumn("_o_num", _as_number(df, order_col))
    return tmp.withColumn("_bkt", _bucket_expr("_o_num", bounds)).drop("_o_num"), len(bounds) + 1


def prefix_sums(df: DataFrame, order_cols: list[str], sum_cols: list[str], buckets: int = 64,
                partition_cols: list[str] | None = None, inclusive: bool = True) -> DataFrame:
    """Running sums of ``sum_cols`` in ``order_cols`` order (first order column drives buckets).

    Adds ``cum_<col>`` for each column.  ``order_cols`` must give a total order
    within each partition for the running sum to be row-exact.
    """
    parts = list(partition_cols or [])
    b, nb = range_buckets(df, order_cols[0], buckets)
    w = Window.partitionBy(*parts, "_bkt").orderBy(*order_cols)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = b
    for c in sum_cols:
        local = local.withColumn(f"_loc_{c}", F.coalesce(F.sum(c).over(frame), F.lit(0)))
    totals = b.groupBy(*parts, "_bkt").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    # offsets: totals of all earlier buckets (table has <= buckets rows per partition key)
    wb = Window.partitionBy(*parts).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*parts, "_bkt", *[F.coalesce(F.sum(f"_tot_{c}").over(wb), F.lit(0)).alias(f"_off_{c}")
                                           for c in sum_cols])
    if not parts:
        offs = F.broadcast(offs)
    out = local.join(offs, [*parts, "_bkt"], "left")
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_loc_{c}") + F.coalesce(F.col(f"_off_{c}"), F.lit(0)))
    return out.drop("_bkt", *[f"_loc_{c}" for c in sum_cols], *[f"_off_{c}" for c in sum_cols])


def rank_ranges(counts: DataFrame, value: str, weight: str, parts: list[str], bucket: Column) -> DataFrame:
    """Ranks that every value of a (parts, value, weight) table holds in its part.

    Adds ``_lo`` and ``_hi`` (0-based ranks ``_lo <= r < _hi`` are rows of this value) and ``_n`` (rows of the part).
    ``bucket`` must rise with ``value``; one task sorts one bucket of one part, and buckets are shifted by the totals
    of those before them.  Null keys are a part of their own; a null value sorts first, by Spark's order.
    """
    b = counts.withColumn("_bkt", bucket)
    frame = Window.partitionBy(*parts, "_bkt").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("_hi", F.sum(weight).over(frame))
    keys = [*parts, "_bkt"]
    part = Window.partitionBy(*[f"_k{i}" for i in range(len(parts))])
    earlier = part.orderBy(f"_k{len(parts)}").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (b.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.sum(weight).alias("_t"))
                .withColumn("_off", F.coalesce(F.sum("_t").over(earlier), F.lit(0)))
                .withColumn("_n", F.sum("_t").over(part)))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = local.join(offsets, same).withColumn("_hi", F.col("_hi") + F.col("_off"))
    return out.withColumn("_lo", F.col("_hi") - F.col(weight)).drop("_bkt", "_t", "_off", *[f"_k{i}" for i in range(len(keys))])


def dense_index(df: DataFrame, order_cols: list[str], partition_cols: list[str] | None = None,
                buckets: int = 64) -> DataFrame:
    """0-based row index in ``order_cols`` order per partition, computed in parallel."""
    out = prefix_sums(df.withColumn("_one", F.lit(1)), order_cols, ["_one"], buckets, partition_cols)
    return out.withColumn("idx", (F.col("cum__one") - 1).cast("bigint")).drop("_one", "cum__one")


def halo_frames(df: DataFrame, order_col: str, halo: int, block: int = 4096,
                partition_cols: list[str] | None = None, buckets: int = 64,
                lead: int = 0) -> tuple[DataFrame, list[str]]:
    """Lay a long ordered series out in overlapping blocks.

    Returns ``(frame, keys)`` where ``frame`` has columns ``idx`` (dense index),
    ``_blk`` and ``_own`` (True for the row's home block) and ``keys`` are the
    window partition keys to use.  Windows reaching ``halo`` rows back (and
    ``lead`` rows forward) over ``partitionBy(*keys).orderBy("idx")`` are exact
    on rows with ``_own``.
    """
    if halo + lead >= block:
        raise ValueError("block must exceed the frame length")
    parts = list(partition_cols or [])
    idx = dense_index(df, [order_col], parts, buckets)
    home = idx.withColumn("_blk", F.floor(F.col("idx") / block).cast("bigint")).withColumn("_own", F.lit(True))
    copies = []
    if halo > 0:
        # last `halo` rows of block b are copied into block b+1
        copies.append(home.where((F.col("idx") % block) >= block - halo)
                          .withColumn("_blk", F.col("_blk") + 1).withColumn("_own", F.lit(False)))
    if lead > 0:
        copies.append(home.where((F.col("idx") % block) < lead)
                          .withColumn("_blk", F.col("_blk") - 1).withColumn("_own", F.lit(False)))
    frame = home
    for c in copies:
        frame = frame.unionByName(c)
    return frame, [*parts, "_blk"]
