"""Faults found before, kept out: conditioning of lag regressions, link functions, refusals, corrupt lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from custos.functions.special import t_quantile_975
from custos.operators import clv, docs, forecast, linkage, marts, ml, timeseries as ts
from custos.session import ensure_checkpoint_dir
from custos.sources import files
from custos.streaming import streams

LEVEL = 1e9


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(11)
    y = [0.0]
    for _ in range(299):
        y.append(0.6 * y[-1] + rng.standard_normal())
    y = LEVEL + 50 * np.array(y)
    return y, spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)] + [("b", i, float(-v)) for i, v in enumerate(y)], "s string, t int, y double")


def lagged(y, p):
    c = y - y.mean()
    return np.column_stack([np.ones(len(y) - p), *(c[p - k:len(y) - k] for k in range(1, p + 1))]), c[p:]


@pytest.mark.parametrize("p", [1, 2])
def test_autoregression_equals_qr_at_a_large_level(series, p):
    y, df = series
    x, target = lagged(y, p)
    beta = np.linalg.lstsq(x, target, rcond=None)[0]
    rows = {r["s"]: r for r in forecast.ar_fit(df, ["s"], "t", "y", p=p).collect()}
    assert np.allclose(rows["a"]["coef"][1:], beta[1:], rtol=1e-6) and np.allclose(rows["b"]["coef"][1:], beta[1:], rtol=1e-6)
    assert np.isclose(rows["a"]["sigma2"], ((target - x @ beta) ** 2).mean(), rtol=1e-6)
    assert np.isclose(rows["a"]["coef"][0], beta[0] + y.mean() * (1 - beta[1:].sum()), rtol=1e-6)
    alone = forecast.ar_fit(df.where("s = 'a'").drop("s"), [], "t", "y", p=p).first()
    assert np.allclose(alone["coef"], rows["a"]["coef"], rtol=1e-6)


def test_orders_share_a_sample_and_are_ranked_per_difference(series):
    _, df = series
    rows = forecast.ar_order_search(df, ["s"], "t", "y", max_p=3).collect()
    assert sorted((r["s"], r["d"]) for r in rows) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert {r["n"] for r in rows if r["d"] == 0} == {297}


def test_partial_autocorrelation_equals_qr(series):
    y, df = series
    got = {r["lag"]: r["pacf"] for r in ts.pacf(df.where("s = 'a'"), ["s"], "t", "y", 3).collect()}
    for k in (1, 2, 3):
        x, target = lagged(y, 3)
        assert np.isclose(got[k], np.linalg.lstsq(x[:, :k + 1], target, rcond=None)[0][-1], atol=1e-6)


def test_dickey_fuller_equals_qr(series):
    y, df = series
    r = ts.adf(df.where("s = 'a'").drop("s"), [], "t", "y", max_lag=0).first()
    c, d = (y - y.mean())[1:-1], np.diff(y)[1:]
    x = np.column_stack([np.ones(len(c)), c])
    beta = np.linalg.lstsq(x, d, rcond=None)[0]
    rss = ((d - x @ beta) ** 2).sum()
    if r["nobs"] == len(d):
        t = beta[1] / np.sqrt(rss / (len(d) - 2) * np.linalg.inv(x.T @ x)[1, 1])
        assert np.isclose(r["adf_stat"], t, rtol=1e-6) and np.isclose(r["aic"], len(d) * np.log(rss / len(d)) + 4, rtol=1e-6)
    assert -12 < r["adf_stat"] < -5


def test_poisson_uses_the_log_link(spark):
    rows = [(float(x), float(round(np.exp(0.5 + 0.8 * x)))) for x in np.linspace(0, 4, 60)]
    got = {r["term"]: r["coef"] for r in ml.glm_table(spark.createDataFrame(rows, "x double, n double"), ["x"], "n", family="poisson").collect()}
    assert abs(got["x"] - 0.8) < 0.02 and abs(got["intercept"] - 0.5) < 0.1


def test_nearest_distance_takes_more_queries_than_a_block(spark):
    rng = np.random.default_rng(1)
    q, c = rng.random((57, 2)), rng.random((40, 2))
    frame = lambda m, n: spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(m)], f"{n} int, x double, y double")
    got = {r["q"]: r["nn_distance"] for r in ml.nearest_distance(frame(q, "q"), frame(c, "c"), ["x", "y"], "q", max_queries=10).collect()}
    want = np.sqrt(((q[:, None] - c[None]) ** 2).sum(2)).min(1)
    assert np.allclose([got[i] for i in range(57)], want)


def test_corrupt_lines_are_marked(spark):
    df = spark.createDataFrame([("f", "a,b\n1,2.5\nx,y\n")], "filename string, _csv string")
    df = df.selectExpr("filename", "concat('data:text/csv;base64,', base64(encode(_csv, 'UTF-8'))) AS contents")
    rows = files.ingest_payloads(df, "a int, b double").collect()
    assert [(r["a"], r["_corrupt"]) for r in rows] == [(1, None), (None, "x,y")]


def test_t_quantile_of_few_degrees():
    assert abs(t_quantile_975(1) - 12.7062) < 1e-3 and abs(t_quantile_975(2) - 4.30265) < 1e-4


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_an_unreadable_target_raises_and_keeps_its_files(spark, tmp_path):
    target = tmp_path / "result"
    target.mkdir()
    (target / "part-0.parquet").write_bytes(b"this is not a table")
    assert linkage.path_exists(spark, str(target)) and not linkage.path_exists(spark, str(tmp_path / "none"))
    batch = spark.createDataFrame([("2020-01-01", 1.0)], "dt string, _ingested double")
    with pytest.raises(Exception):
        streams._merge_last_per_key(spark, batch, str(target), "dt", "_ingested")
    assert (target / "part-0.parquet").read_bytes() == b"this is not a table"


def test_t_quantile_between_whole_degrees():
    assert abs(t_quantile_975(5) - 2.570582) < 1e-6 and abs(t_quantile_975(40) - 2.021075) < 1e-6
    assert t_quantile_975(1) < t_quantile_975(0.98) and abs(t_quantile_975(1e7) - 1.959964) < 1e-5


def line(n, start, step, missing=()):
    import datetime as dt
    return [(dt.date(2020, 1, 1) + dt.timedelta(t), None if t in missing else start + step * t) for t in range(n)]


@pytest.mark.parametrize("missing", [(), (1, 9)])
def test_dynamic_model_is_exact_on_a_line(spark, missing):
    df = spark.createDataFrame(line(20, 100.0, 10.0, missing), "dt date, y double")
    rows = forecast.dlm(df, [], "dt", "y", periods=(), harmonics=(), prior_len=6, h=3).toPandas()
    inside = rows[rows.step == 0].sort_values("dt")
    assert inside.forecast[:6].isna().all()
    assert np.allclose(inside.forecast[6:], [100 + 10 * t for t in range(6, 20)], atol=1e-3)
    assert np.allclose(rows[rows.step > 0].sort_values("step").forecast, [300, 310, 320], atol=1e-3)


def test_dynamic_model_follows_scenarios(spark):
    rng = np.random.default_rng(4)
    x = rng.random(60)
    rows = [("a", d, float(50 + v * 8), float(v)) for (d, _), v in zip(line(60, 0.0, 0.0), x)]
    df = spark.createDataFrame(rows, "k string, dt date, y double, x double")
    last = df.groupBy("k").agg({"x": "max"}).withColumnRenamed("max(x)", "last")
    paths = ts.scenario_paths(last, "last", levels=(0.0, 1.0), horizon=4, out="x")
    out = forecast.dlm(df, ["k"], "dt", "y", ["x"], periods=(), harmonics=(), prior_len=10, future=paths, scenario="scenario").toPandas()
    ahead = out[out.step > 0].groupby("scenario").forecast.apply(list)
    assert np.allclose(ahead[0], 50 + 8 * x.max(), atol=0.1) and np.allclose(ahead[1], 50, atol=0.1) and np.allclose(ahead[2], 58, atol=0.1)


def test_spend_fit_does_not_depend_on_the_currency(spark):
    rng = np.random.default_rng(8)
    n = 4000
    x = rng.integers(1, 12, n)
    m = rng.gamma(6.0 * x) / (x * rng.gamma(4.0, 1 / 15.0, n))
    fits = [clv.fit_gamma_gamma(spark.createDataFrame([(int(a), float(b * f)) for a, b in zip(x, m)], "frequency long, monetary_value double")) for f in (1.0, 1e5)]
    assert abs(fits[0].p - 6) < 1.5 and abs(fits[0].q - 4) < 0.5 and abs(fits[0].p * fits[0].v / 90 - 1) < 0.3
    assert np.isclose(fits[0].q, fits[1].q, rtol=1e-3) and np.isclose(fits[1].v, 1e5 * fits[0].v, rtol=1e-2)


def test_vector_search_takes_blocks_of_queries_and_breaks_ties_by_id(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-2, 3, (60, 4)).astype(float) + 0.5
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    queries = df.where("vec_id < 25").toDF("query_id", "query_vec")
    whole = {(r[0], r[1]): r[2:] for r in docs.top_k_vectors(queries, df, 4).collect()}
    parts = {(r[0], r[1]): r[2:] for r in docs.top_k_vectors(queries, df, 4, block_queries=6).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    best = -np.sort(-(u[:25] @ u.T), axis=1)[:, :4]
    assert len(whole) == 100 and whole.keys() == parts.keys()
    assert all(np.isclose(got[k][1], best[k[0], k[1] - 1]) for got in (whole, parts) for k in whole)


def test_gap_has_a_row_for_one_cluster(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(70)], "a double, b double")
    assert [r["k"] for r in ml.gap_statistic(df, ["a", "b"], k_max=2, b=2).orderBy("k").collect()] == [1, 2]


def test_cached_rows_are_dealt_over_tasks_by_their_number(spark):
    cores = spark.sparkContext.defaultParallelism
    assert ml.spread(spark.range(1000).coalesce(1), 1000).rdd.getNumPartitions() == 1
    dealt = ml.spread(spark.range(1000).coalesce(1), 1000 // (3 * cores))
    assert dealt.count() == 1000 and dealt.rdd.getNumPartitions() >= 3 * cores


def _sales_lines(spark, orders):
    return (spark.range(2 * orders).selectExpr("id div 2 as order_id", "date_add(date'2024-01-01', cast(id div 2 % 30 as int)) as order_date",
                                               "cast(id % 2 as int) as sku", "cast(id as decimal(18,2)) as gross_margin", "cast(id + 1 as decimal(18,2)) as product_price",
                                               "cast(1 as decimal(18,2)) as product_discount_amount", "cast(1 as int) as num_units", "1 as valid_order_flag"))


def test_weekly_sales_group_orders_once_and_in_bounded_tasks(spark, monkeypatch):
    lines = _sales_lines(spark, 300)
    lines = lines.unionByName(lines.limit(1).withColumn("order_id", F.lit(None).cast("long")))
    plain = sorted(map(tuple, marts.weekly_sales(lines).collect()), key=str)
    assert sum(r[-1] for r in plain) == 300  # a null order is no order
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(marts, "ORDER_ROWS", -(-601 // (4 * cores)), raising=False)
    weekly = marts.weekly_sales(lines)
    plan = weekly._jdf.queryExecution().toString()
    assert "distinct" not in plan.lower() and "hashpartitioning(order_date" in plan and "REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, weekly.collect()), key=str) == plain


def test_kprototypes_reads_its_input_from_the_cache(spark):
    df = spark.range(200).selectExpr("cast(id % 17 as double) as x", "cast(id % 5 as double) as y", "cast(id % 3 as string) as c")
    out, _ = ml.kprototypes(df, ["x", "y"], ["c"], 3, iters=6)
    assert out.count() == 200 and "InMemoryRelation" in out._jdf.queryExecution().withCachedData().toString()


def test_text_files_are_dealt_over_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(docs, "FILES", 3)
    texts = {i: f"text {i}\nof two lines" for i in range(40)}
    docs.write_text_dir(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), f"{tmp_path}/d")
    files = {f.parent.name: f.name for f in (tmp_path / "d").rglob("*.txt")}
    assert set(files) == {f"doc_id={i}" for i in texts} and len({f.split("-")[1] for f in files.values()}) > 5
    got = {int(r["doc_id"].split("doc_id=")[1].split("/")[0]): r["text"] for r in docs.read_text_dir(spark, f"{tmp_path}/d").collect()}
    assert {i: t.rstrip("\n") for i, t in got.items()} == texts


def test_lexical_hits_are_counted_in_tasks(spark):
    rng = np.random.default_rng(4)
    text = lambda n: " ".join(rng.choice(list("abcdefghijkl"), n))
    q = [(i % 9, text(3)) for i in range(12)] + [(None, "a b"), (77, None)]  # ids repeat or are null
    c = [(i % 40, i % 2, text(6), 6) for i in range(70)] + [(90, 0, None, 0)]
    got = docs.top_k_lexical(spark.createDataFrame(q, "query_id long, text string"), spark.createDataFrame(c, "doc_id long, chunk_id int, text string, n_tokens int"), 3)
    score = {}
    for i, t in q:
        for d, k, u, _ in c:
            shared = len(set((t or "").split()) & set((u or "").split()))
            if shared:
                score[i, d, k] = score.get((i, d, k), 0) + shared
    want = []
    for i in {x[0] for x in score}:
        best = sorted((-s, d, k) for (j, d, k), s in score.items() if j == i)[:3]
        want += [(i, r, d, k, -s, 6) for r, (s, d, k) in enumerate(best, 1) for x in c if x[:2] == (d, k)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow", 1)[1]
