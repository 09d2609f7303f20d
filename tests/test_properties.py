"""Property and closed-form checks for operators without an exact SQL oracle."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custos.functions.special import hyp2f1_np, lgamma_np
from custos.functions.text import jaro_winkler_py
from custos.operators import clv, layout, ml, stats, timeseries as ts


def test_jaro_winkler_known_values():
    assert round(jaro_winkler_py("martha", "marhta"), 5) == 0.96111
    assert round(jaro_winkler_py("abcdzz", "abqrst"), 5) == 0.55556
    assert jaro_winkler_py("", "") == 0.0
    assert jaro_winkler_py("abc", "abc") == 1.0


def test_lgamma_and_hyp2f1():
    for x in (0.1, 0.5, 1.0, 3.7, 25.0, 1e3):
        assert abs(lgamma_np(x) - math.lgamma(x)) < 1e-10
    # 2F1(1,1;2;z) = -ln(1-z)/z
    z = np.array([0.1, 0.5, 0.9])
    assert np.allclose(hyp2f1_np(1.0, 1.0, 2.0, z), -np.log(1 - z) / z, rtol=1e-10)


def test_prefix_sums_match_cumsum(spark):
    pdf = pd.DataFrame({"k": np.arange(2000), "v": np.random.default_rng(1).integers(0, 100, 2000)})
    df = spark.createDataFrame(pdf)
    out = layout.prefix_sums(df, ["k"], ["v"], buckets=7).orderBy("k").toPandas()
    assert (out["cum_v"].to_numpy() == np.cumsum(pdf["v"].to_numpy())).all()


def test_halo_rolling_equals_single_window(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"t": np.arange(500), "x": rng.normal(size=500)})
    df = spark.createDataFrame(pdf)
    sf = ts.SeriesFrame(df, [], "t", halo=9, block=40)
    out = sf.finish(sf.df.withColumn("m", F.avg("x").over(sf.rows(-9, 0)))).orderBy("t").toPandas()
    ref = pdf["x"].rolling(10, min_periods=1).mean().to_numpy()
    assert np.allclose(out["m"].to_numpy(), ref)


def test_ewm_matches_recurrence(spark):
    x = np.random.default_rng(3).normal(size=300)
    df = spark.createDataFrame(pd.DataFrame({"t": np.arange(300), "x": x}))
    a = 2 / 13
    got = ts.ewm(df, [], "t", "x", a, adjust=False).orderBy("t").toPandas()["ewm_x"].to_numpy()
    y = np.empty_like(x)
    y[0] = x[0]
    for i in range(1, len(x)):
        y[i] = (1 - a) * y[i - 1] + a * x[i]
    assert np.allclose(got, y, atol=1e-12)
    got_adj = ts.ewm(df, [], "t", "x", a, adjust=True).orderBy("t").toPandas()["ewm_x"].to_numpy()
    w = (1 - a) ** np.arange(300)
    ref = np.array([np.dot(w[:i + 1][::-1], x[:i + 1]) / w[:i + 1].sum() for i in range(300)])
    assert np.allclose(got_adj, ref, atol=1e-12)


def test_ewm_with_nulls_matches_pandas(spark):
    x = np.random.default_rng(4).normal(size=120)
    x[[0, 1, 5, 6, 7, 30, 90, 91]] = np.nan
    for values in (x, np.array([1, 2, np.nan, 4])):
        rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "t int, x double")
        for adjust in (True, False):
            got = ts.ewm(df, [], "t", "x", 2 / 3, adjust=adjust).orderBy("t").toPandas()["ewm_x"].to_numpy(float)
            want = pd.Series(values).ewm(alpha=2 / 3, adjust=adjust).mean().to_numpy()
            assert np.allclose(got, want, rtol=1e-11, atol=1e-11, equal_nan=True)
            assert not adjust or len(values) > 4 or np.allclose(got, [1, 1.75, 1.75, 3.7096774], atol=1e-7)


def test_expected_purchases_properties():
    m = clv.BGParams(0.25, 4.0, 0.8, 2.5)
    x, tx, T = np.array([0, 2, 5.0]), np.array([0, 10, 20.0]), np.array([30, 30, 30.0])
    assert np.allclose(clv.expected_purchases_np(np.zeros(3), x, tx, T, m), 0)
    e1 = clv.expected_purchases_np(np.full(3, 6.0), x, tx, T, m)
    e2 = clv.expected_purchases_np(np.full(3, 12.0), x, tx, T, m)
    assert (e2 > e1).all() and (e1 > 0).all()


def test_bgnbd_fit_recovers_simulated_parameters(spark):
    rng = np.random.default_rng(7)
    n, T = 4000, 40.0
    r, alpha, a, b = 0.5, 6.0, 0.7, 2.5
    lam = rng.gamma(r, 1 / alpha, n)
    p = rng.beta(a, b, n)
    rows = []
    for i in range(n):
        t, x, tx, alive = 0.0, 0, 0.0, True
        while alive:
            t += rng.exponential(1 / lam[i])
            if t > T:
                break
            x, tx = x + 1, t
            alive = rng.random() > p[i]
        rows.append((i, x, tx, T))
    df = spark.createDataFrame(rows, "customer_id long, frequency long, recency double, T double")
    fit = clv.fit_bgnbd(df, tol=1e-5)
    assert abs(fit.r - r) / r < 0.25 and abs(fit.a - a) / a < 0.4 and abs(fit.b - b) / b < 0.6


def test_auc_rank_formula_equals_trapezoid(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + y * 0.3, 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    auc = stats.auc(df, "y", "s").first()["auc"]
    roc = stats.roc_points(df, "y", "s").orderBy(F.desc("threshold")).toPandas()
    fpr = np.concatenate([[0], roc["fpr"].to_numpy()])
    tpr = np.concatenate([[0], roc["tpr"].to_numpy()])
    assert abs(auc - np.trapezoid(tpr, fpr)) < 1e-12
    assert 0 <= auc <= 1


def test_gamma_gamma_clv_zero_discount(spark):
    bg, gg = clv.BGParams(0.25, 4.0, 0.8, 2.5), clv.GGParams(6.0, 4.0, 15.0)
    df = spark.createDataFrame([(1, 3, 10.0, 20.0, 50.0)], "customer_id long, frequency long, recency double, T double, monetary_value double")
    out = clv.clv(df, bg, gg, months=6, discount=0.0, digits=9).first()
    e6 = clv.expected_purchases_np(6.0, 3, 10.0, 20.0, bg)
    assert abs(out["predicted_cltv"] - round(out["exp_profit"], 9) * 0 - e6 * (
        (6 * 3) / (6 * 3 + 3) * 50 + (1 - (6 * 3) / (6 * 3 + 3)) * 6 * 15 / 3)) < 1e-6


def test_keyed_halo_equals_partitioned_window(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.repeat(["a", "b", "c"], [400, 30, 250]),
                        "t": np.concatenate([np.arange(400), np.arange(30), np.arange(250)]),
                        "x": rng.normal(size=680)})
    df = spark.createDataFrame(pdf)
    halo = ts.SeriesFrame(df, ["k"], "t", halo=4, block=64, layout="halo")
    part = ts.SeriesFrame(df, ["k"], "t", halo=4, layout="partition")
    a = halo.finish(halo.df.withColumn("m", F.sum("x").over(halo.rows(-4, 0)))).orderBy("k", "t").toPandas()
    b = part.finish(part.df.withColumn("m", F.sum("x").over(part.rows(-4, 0)))).orderBy("k", "t").toPandas()
    assert np.allclose(a["m"].to_numpy(), b["m"].to_numpy())


def test_special_digamma_trigamma():
    from custos.operators.forecast import _digamma, _trigamma
    # digamma(1) = -Euler gamma, trigamma(1) = pi^2/6, recurrence psi(x+1) = psi(x) + 1/x
    assert abs(_digamma(1.0) + 0.5772156649015329) < 1e-10
    assert abs(_trigamma(1.0) - math.pi ** 2 / 6) < 1e-10
    assert abs(_digamma(3.5) - _digamma(2.5) - 1 / 2.5) < 1e-12


def test_count_dlm_tracks_constant_rate(spark):
    from custos.operators.forecast import count_dlm
    pdf = pd.DataFrame({"k": "a", "t": pd.date_range("2024-01-01", periods=60).date, "y": 5.0})
    out = count_dlm(spark.createDataFrame(pdf), ["k"], "t", "y").orderBy("t").toPandas()
    assert abs(out["mean"].iloc[-1] - 5.0) < 0.5


def test_exact_quantiles_both_paths_agree(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "x": np.round(rng.normal(size=900), 2)})
    df = spark.createDataFrame(pdf)
    probs = [0.025, 0.25, 0.5, 0.975]
    a = stats.exact_quantiles(df, ["g"], "x", probs, max_buffer=10 ** 9).orderBy("g").toPandas()
    b = stats.exact_quantiles(df, ["g"], "x", probs, max_buffer=0).orderBy("g").toPandas()
    ref = pdf.groupby("g")["x"].quantile(probs).unstack().to_numpy()
    assert np.allclose(a[[f"q{i}" for i in range(4)]].to_numpy(), ref)
    assert np.allclose(b[[f"q{i}" for i in range(4)]].to_numpy(), ref)


def test_best_normalize_many_rows_and_bins(spark):
    """At 600,000 rows there are over 400 bins: a comparison a bin and candidate overflowed the stack of the planner."""
    n = 600_000
    got = {r["transform"]: r["chi2_df"] for r in ml.best_normalize(spark.range(1, n + 1).select(F.sqrt("id").alias("v")), "v", (0.5, 2.0)).collect()}
    bins = int(np.ceil(2 * n ** 0.4))
    bounds = [ml._norm_ppf(i / bins) for i in range(1, bins)]
    x = np.sqrt(np.arange(1, n + 1))
    for name, v in {"identity": x, "log": np.log(x), "boxcox_2p0": (x ** 2 - 1) / 2}.items():
        o = np.bincount(np.searchsorted(bounds, (v - v.mean()) / v.std(ddof=1)), minlength=bins)
        assert np.isclose(got[name], (np.sum(o * o) / (n / bins) - n) / (bins - 1), rtol=1e-3)
    assert min(got, key=got.get) == "rank_normal" and ml.best_normalize(spark.range(0).select(F.col("id").alias("v")), "v").count() == 0
