"""Streaming results equal their batch forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from custos.sources.fixtures import fixture
from custos.streaming import streams as S
from custos.streaming.streams import online_dlm_batch
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((r["series_id"], r["dt"], r["y"], None if r["forecast"] is None else round(r["forecast"], 9))
                  for r in df.collect())


def test_online_dlm_stream_equals_batch(spark):
    streamed = E.queries()["event_online_dlm"](spark, SF_SMALL)
    e = fixture(spark, SF_SMALL, "event_daily").select("series_id", "dt", F.col("value").cast("double").alias("value"))
    assert _rows(streamed) == _rows(online_dlm_batch(e))


def test_daily_upsert_keeps_one_row_per_date(spark):
    out = E.queries()["daily_stream_upsert"](spark, SF_SMALL)
    assert out.count() == out.select("dt").distinct().count() > 0


def test_incremental_stream_equals_batch(spark):
    streamed = E.queries()["people_stream_incremental"](spark, SF_SMALL)
    batch = E.queries()["incremental_merge"](spark, SF_SMALL)
    key = lambda df: sorted((r["customer_id"], r["email"]) for r in df.collect())
    assert key(streamed) == key(batch)


def _days(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, "dt date, v int").coalesce(1).write.mode(mode).parquet(path)


def test_two_versions_of_a_day_in_one_run_and_later_files(spark, tmp_path):
    src, target, ckpt = (str(tmp_path / n) for n in ("src", "target", "ckpt"))
    d = dt.date
    _days(spark, src, [(d(2024, 1, 1), 1), (d(2024, 1, 2), 2), (d(2024, 1, 1), 3), (None, 9)])
    S.upsert_daily_stream(spark, src, "dt date, v int", target, ckpt)
    got = lambda: {r["dt"]: r["v"] for r in spark.read.parquet(target).collect()}
    assert got() == {d(2024, 1, 1): 3, d(2024, 1, 2): 2, None: 9}
    january = {p.name for p in (tmp_path / "target" / "_part=2024-01").iterdir()}
    _days(spark, src, [(d(2024, 2, 1), 5), (d(2024, 2, 1), 6)])
    S.upsert_daily_stream(spark, src, "dt date, v int", target, ckpt)
    assert got() == {d(2024, 1, 1): 3, d(2024, 1, 2): 2, d(2024, 2, 1): 6, None: 9}
    assert {p.name for p in (tmp_path / "target" / "_part=2024-01").iterdir()} == january  # untouched partitions stay


def test_replayed_and_older_batches_change_nothing(spark, tmp_path):
    target = str(tmp_path / "target")
    rows = lambda v, t: spark.createDataFrame([(dt.date(2024, 1, 1), v, t), (dt.date(2024, 1, 5), v, t)], "dt date, v int, _version int")
    part = F.date_format("dt", "yyyy-MM")
    for v, t in ((1, 1), (2, 2), (2, 2), (1, 1)):
        S.merge_newest(spark, rows(v, t), target, "dt", part)
    assert sorted((r["dt"].day, r["v"]) for r in spark.read.parquet(target).collect()) == [(1, 2), (5, 2)]
    out = str(tmp_path / "appended")
    for epoch in (0, 1, 1, 0):
        S.append_batch(spark.createDataFrame([(epoch,)], "x int"), out, "ckpt", epoch)
    S.append_batch(spark.createDataFrame([(7,)], "x int"), out, "another checkpoint", 0)
    assert sorted(r["x"] for r in spark.read.parquet(out).collect()) == [0, 1, 7]


def test_a_target_that_cannot_be_read_is_an_error(spark, tmp_path):
    part = tmp_path / "target" / "_part=2024-01"
    part.mkdir(parents=True)
    (part / "part-0.parquet").write_bytes(b"not a parquet file")
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 1)], "dt date, v int, _version int")
    with pytest.raises(Exception):
        S.merge_newest(spark, rows, str(tmp_path / "target"), "dt", F.date_format("dt", "yyyy-MM"))
    assert (part / "part-0.parquet").read_bytes() == b"not a parquet file"


def test_any_arrival_order_within_the_buffer_gives_the_batch_result():
    rng = random.Random(2)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 10 + 0.3 * i + rng.random()) for i in range(60)]
    want, _ = S._online_steps(rows, None)
    for _ in range(5):
        order = sorted(range(60), key=lambda i: i + rng.uniform(0, 8))
        state, last = None, {}
        for k in range(0, 60, 7):
            out, state = S._online_update([rows[i] for i in order[k:k + 7]], state, 20)
            assert all(r[6] == "ok" for r in out)
            last.update({r[0]: r[:5] for r in out})
        assert [last[d] for d, _ in rows] == want
    out, state = S._online_update([rows[0], rows[50], (dt.date(2025, 1, 1), None)], state, 20)
    assert sorted(r[6] for r in out) == ["late", "null", "repeat"]


def test_late_day_through_the_stream(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    rows = [("a", dt.date(2024, 1, 1 + i), float(i % 5)) for i in range(12)]
    schema = "series_id string, dt date, value double"
    for wave in ([*rows[:4], *rows[5:9]], [rows[4], *rows[9:], ("a", dt.date(2024, 1, 20), None)]):
        spark.createDataFrame(wave, schema).coalesce(1).write.mode("append").parquet(src)
        S.online_dlm_stream(spark, src, schema, out, ckpt, late_days=6)
    assert _rows(S.online_results(spark, out)) == _rows(online_dlm_batch(spark.createDataFrame(rows, schema)))
    assert [r["status"] for r in spark.read.parquet(out).where("status <> 'ok'").collect()] == ["null"]
