"""Incremental jobs on Structured Streaming (Q1, Q2, Q3).

All read a file source with ``trigger(availableNow=True)``: every run picks up
the files that arrived since the last run (the checkpoint replaces the
reference's high-water-mark query) and stops.  A micro-batch can be replayed
after a failure, so what ``foreachBatch`` writes is exactly-once by place: an
appended batch owns one partition of the target, named by the stream and its
epoch, which a replay replaces; a merged batch replaces the date partitions it
touches by the newest version of every row, which a replay computes again.  A
target that is there but cannot be read is an error, never taken as empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custos.operators import linkage as lk

VERSION = "_version"  # (time, name, row) of the file row that a target row came from
PART = "_part"
BATCH = "_batch"


def _replace_partitions(df: DataFrame, target: str, part: str) -> None:
    """Write ``df``; the partitions of the target that it has rows for are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(target)


def merge_newest(spark: SparkSession, batch: DataFrame, target: str, key: str, part: Column) -> None:
    """Merge rows with a ``VERSION`` column into ``target``: per ``key`` the row of the highest version stays.

    Only partitions (values of ``part``, a function of the key) with rows in the
    batch are read and replaced.  Versions are a total order, so merging a batch
    again, or an older one after a newer, changes nothing.
    """
    rows = batch.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none")))
    if lk.path_exists(spark, target):
        touched = rows.select(PART).distinct()
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(target).join(F.broadcast(touched), PART, "left_semi").select(*rows.columns))
    newest = rows.groupBy(PART, key).agg(F.max_by(F.struct(*rows.columns), VERSION).alias("_row")).select("_row.*")
    _replace_partitions(newest.checkpoint(), target, PART)  # computed before its inputs are replaced


def _files(spark: SparkSession, source_dir: str, schema: str) -> DataFrame:
    src = spark.readStream.schema(schema).parquet(source_dir)
    place = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return src.select("*", place.alias(VERSION))


def upsert_daily_stream(spark: SparkSession, source_dir: str, schema: str, target: str, checkpoint: str,
                        key: str = "dt") -> None:
    """Q2: append newly uploaded days, keep the last version per date.

    A later file is newer, and in a file the later row.  The target is
    partitioned by month (``_part``); its rows carry their version.
    """
    def merge(batch: DataFrame, _epoch: int) -> None:
        merge_newest(spark, batch, target, key, F.date_format(key, "yyyy-MM"))

    (_files(spark, source_dir, schema).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination())


def append_batch(rows: DataFrame, target: str, checkpoint: str, epoch: int) -> None:
    """Append one micro-batch as a partition of its own: a replay of the epoch replaces it."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    _replace_partitions(rows.withColumn(BATCH, F.lit(f"{stream}-{epoch}")), target, BATCH)


def incremental_match_stream(spark: SparkSession, new_dir: str, schema: str, old: DataFrame, target: str,
                             checkpoint: str, run_ts: str) -> None:
    """Q1: each batch of new customer records is matched against the known records and appended."""
    src = spark.readStream.schema(schema).parquet(new_dir)
    old_clean = lk.clean_people(old)

    def merge(batch: DataFrame, epoch: int) -> None:
        new = lk.clean_people(batch)
        matches = lk.incremental_match(new, old_clean)
        append_batch(lk.incremental_merge(matches, old_clean, new, run_ts), target, checkpoint, epoch)

    (src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination())


# ------------------------------------------------------------ Q3 online DLM
ONLINE_OUT = "series_id string, dt date, y double, forecast double, lower double, upper double"
ONLINE_STATE = ("m0 double, m1 double, c00 double, c01 double, c11 double, s double, nu double, last_dt date, "
                "days array<date>, values array<double>, seq long")
ONLINE_STREAM = f"{ONLINE_OUT}, seq long, status string"
LATE_DAYS = 30


def _online_steps(rows, state, discount: float = 0.95, delta_v: float = 0.98):
    """Local linear trend with discounting, one observation at a time.

    ``state`` is None or (m0, m1, c00, c01, c11, s, nu, last_dt); returns the
    output rows and the new state.  Rows at or before ``last_dt`` are ignored
    (replayed data does not update twice).
    """
    import math

    import numpy as np
    from custos.functions.special import t_quantile_975
    out = []
    st = state
    for dt_, y in rows:
        if y is None or (st is not None and st[7] is not None and dt_ <= st[7]):
            continue
        if st is None:
            s0 = max(abs(y), 1.0) ** 2 * 0.01
            st = (y, 0.0, s0 * 100.0, 0.0, s0, s0, 1.0, dt_)
            out.append((dt_, y, None, None, None))
            continue
        m = np.array([st[0], st[1]])
        C = np.array([[st[2], st[3]], [st[3], st[4]]])
        s, nu = st[5], st[6]
        G = np.array([[1.0, 1.0], [0.0, 1.0]])
        a = G @ m
        R = (G @ C @ G.T) / discount
        f = float(a[0])
        q = float(R[0, 0] + s)
        tq = t_quantile_975(delta_v * nu)
        out.append((dt_, y, f, f - tq * math.sqrt(q), f + tq * math.sqrt(q)))
        e = y - f
        A = R[:, 0] / q
        nu_new = delta_v * nu + 1.0
        s_new = s * (delta_v * nu + e * e / q) / nu_new
        m = a + A * e
        C = (s_new / s) * (R - np.outer(A, A) * q)
        st = (float(m[0]), float(m[1]), float(C[0, 0]), float(C[0, 1]), float(C[1, 1]), float(s_new), float(nu_new), dt_)
    return out, st


def online_dlm_batch(df: DataFrame, key: str = "series_id", ts: str = "dt", value: str = "value") -> DataFrame:
    """Q3 (batch form): the same filter over a whole table, one task per series."""
    import pandas as pd

    def run(pdf):
        pdf = pdf.sort_values(ts)
        rows, _ = _online_steps(list(zip(pdf[ts], pdf[value].astype("float64"))), None)
        sid = pdf[key].iloc[0]
        return pd.DataFrame([(sid, *r) for r in rows], columns=["series_id", "dt", "y", "forecast", "lower", "upper"])
    src = df.select(F.col(key).cast("string").alias(key), F.col(ts).cast("date").alias(ts),
                    F.col(value).cast("double").alias(value))
    return src.groupBy(key).applyInPandas(run, ONLINE_OUT)


def _online_update(rows, state, keep: int):
    """One batch of observations (in any order) of one series.

    The state is the filter before the last ``keep`` observations, and these
    themselves; a late day among them is put in its place and the filter run
    again from there.  Returns output rows with (seq, status) and the new state.
    Status: ``ok`` (a later seq corrects an earlier row of the day), ``late``
    (older than what is kept), ``repeat`` (the day is known), ``null``.
    """
    base, recent, seq = None, [], 0
    if state is not None:
        base = None if state[0] is None else tuple(state[:8])
        recent, seq = list(zip(state[8], state[9])), state[10]
    seq += 1
    out, days, first = [], {d for d, _ in recent}, None
    for day, y in sorted(rows, key=lambda r: r[0]):
        status = ("null" if y is None or y != y else "late" if base is not None and day <= base[7] else "repeat" if day in days else None)
        if status:
            out.append((day, None if status == "null" else y, None, None, None, seq, status))
            continue
        days.add(day)
        recent.append((day, y))
        first = day if first is None else first
    recent.sort(key=lambda r: r[0])
    if first is not None:
        done, _ = _online_steps(recent, base)
        out += [(*r, seq, "ok") for r in done if r[0] >= first]
    over = max(0, len(recent) - keep)
    if over:
        _, base = _online_steps(recent[:over], base)
        recent = recent[over:]
    return out, (*(base or (None,) * 8), [d for d, _ in recent], [float(y) for _, y in recent], seq)


def online_dlm_stream(spark: SparkSession, source_dir: str, schema: str, target: str, checkpoint: str,
                      key: str = "series_id", ts: str = "dt", value: str = "value", late_days: int = LATE_DAYS) -> None:
    """Q3: per-series state updated by every new observation (applyInPandasWithState).

    The last ``late_days`` observations of a series stay in the state, so that a
    day that arrives late among them gives the same result as in order; older
    ones, repeats and nulls are written with their status instead of vanishing.
    ``online_results`` reads the target.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def update(k, pdfs, state):
        pdf = pd.concat(list(pdfs))
        days, values = pdf[ts].tolist(), [None if pd.isna(v) else float(v) for v in pdf[value]]
        known = [(d, v) for d, v in zip(days, values) if not pd.isna(d)]
        rows, st = _online_update(known, state.get if state.exists else None, late_days)
        rows += [(None, v, None, None, None, st[10], "null") for d, v in zip(days, values) if pd.isna(d)]
        state.update(st)
        yield pd.DataFrame([(k[0], *r) for r in rows], columns=["series_id", "dt", "y", "forecast", "lower", "upper", "seq", "status"])

    src = (spark.readStream.schema(schema).parquet(source_dir)
                .select(F.col(key).cast("string").alias(key), F.col(ts).cast("date").alias(ts),
                        F.col(value).cast("double").alias(value)))
    q = (src.groupBy(key).applyInPandasWithState(update, ONLINE_STREAM, ONLINE_STATE, "append",
                                                  GroupStateTimeout.NoTimeout)
            .writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def online_results(spark: SparkSession, target: str) -> DataFrame:
    """The last state of every series and day of ``online_dlm_stream``'s target."""
    rows = spark.read.schema(ONLINE_STREAM).parquet(target).where("status = 'ok'")
    last = rows.groupBy("series_id", "dt").agg(F.max_by(F.struct("y", "forecast", "lower", "upper"), "seq").alias("_r"))
    return last.select("series_id", "dt", "_r.*")
