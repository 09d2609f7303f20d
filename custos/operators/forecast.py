"""Forecasting many series at once.

T1 (autoregression with regressors) is fitted from *moment sums*: the lag
columns are built with partitioned windows, then one ``groupBy(series)``
aggregate produces X'X, X'y and y'y per series - an order-free partial +
final aggregate, so even one huge series is fitted in parallel.  Each series'
moments (a single small row) are solved in ``applyInPandas``.

T2 (dynamic linear model, West & Harrison discount filter) is sequential by
nature: each series is filtered inside ``groupBy(series).applyInPandas``,
one task per series, state kept as a small row.  Parallelism is across
series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custos.functions.special import t_quantile_975
from custos.operators.timeseries import SeriesFrame


def ar_design(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str], p: int, d: int = 0) -> DataFrame:
    """Differenced target, its p lags and the (differenced) regressors; rows with full history."""
    sf = SeriesFrame(df, keys, ts, halo=p + d + 1)
    out = sf.df.withColumn("_y", F.col(y).cast("double"))
    for x in xs:
        out = out.withColumn(f"_x_{x}", F.col(x).cast("double"))
    for _ in range(d):
        out = out.withColumn("_y", F.col("_y") - F.lag("_y", 1).over(sf.w))
        for x in xs:
            out = out.withColumn(f"_x_{x}", F.col(f"_x_{x}") - F.lag(f"_x_{x}", 1).over(sf.w))
    for k in range(1, p + 1):
        out = out.withColumn(f"_l{k}", F.lag("_y", k).over(sf.w))
    cols = ["_y"] + [f"_l{k}" for k in range(1, p + 1)] + [f"_x_{x}" for x in xs]
    out = sf.finish(out)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return out.where(cond).select(*keys, ts, *cols)


def _ar_solutions(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str], orders: list[int], d: int) -> DataFrame:
    """OLS fits of every lag order in ``orders`` on the sample of the longest one, per series.

    Every column is centred and scaled by its own mean and deviation of the
    series before products are summed, so large levels lose no digits; the
    coefficients are scaled back and the intercept follows from the means.
    """
    top = max(orders)
    cols = ["_y"] + [f"_l{k}" for k in range(1, top + 1)] + [f"_x_{x}" for x in xs]
    des = ar_design(df, keys, ts, y, xs, top, d)
    location = [F.avg(c).alias(f"mean{c}") for c in cols] + [F.stddev_pop(c).alias(f"sd{c}") for c in cols]
    if keys:
        des = des.join(des.groupBy(*keys).agg(F.struct(*location).alias("_s")), keys)
    else:
        des = des.withColumn("_s", des.agg(F.struct(*location).alias("_s")).scalar())
    unit = {c: F.when(F.col("_s")[f"sd{c}"] > 0, F.col("_s")[f"sd{c}"]).otherwise(1.0) for c in cols}
    z = {c: (F.col(c) - F.col("_s")[f"mean{c}"]) / unit[c] for c in cols}
    aggs = [F.count("*").alias("n"), F.first("_s").alias("_s")]
    aggs += [F.sum(z[p] * z[q]).alias(f"m_{i}_{j}") for i, p in enumerate(cols) for j, q in enumerate(cols) if i <= j]
    mom = des.groupBy(*keys).agg(*aggs) if keys else des.agg(*aggs)
    key_schema = "".join(f"{k} {df.schema[k].dataType.simpleString()}, " for k in keys)
    names = [*keys, "coef", "sigma2", "loglik", "aic", "n", "p", "d"]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            n, scale = int(r["n"]), r["_s"]
            if n == 0:
                continue
            m = np.zeros((len(cols), len(cols)))
            for i in range(len(cols)):
                for j in range(i, len(cols)):
                    m[i, j] = m[j, i] = r[f"m_{i}_{j}"]
            sd = np.array([scale[f"sd{c}"] or 1.0 for c in cols])
            mean = np.array([scale[f"mean{c}"] for c in cols])
            for p in orders:
                at = [*range(1, p + 1), *range(top + 1, len(cols))]
                zz, zy = m[np.ix_(at, at)], m[at, 0]
                beta = np.linalg.lstsq(zz, zy, rcond=None)[0]
                slope = beta * sd[0] / sd[at]
                s2 = max(float(m[0, 0] - 2 * beta @ zy + beta @ zz @ beta) * sd[0] ** 2 / n, 1e-300)
                ll = -0.5 * n * (math.log(2 * math.pi * s2) + 1)
                out.append({**{k: r[k] for k in keys}, "coef": [float(mean[0] - slope @ mean[at]), *slope.tolist()], "sigma2": s2,
                            "loglik": ll, "aic": -2 * ll + 2 * (len(at) + 2), "n": n, "p": p, "d": d})
        return pd.DataFrame(out, columns=names)

    schema = key_schema + "coef array<double>, sigma2 double, loglik double, aic double, n long, p int, d int"
    if keys:
        return mom.groupBy(*keys).applyInPandas(solve, schema)
    return mom.mapInPandas(lambda it: (solve(pdf) for pdf in it), schema)


def ar_fit(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str] | None = None, p: int = 1,
           d: int = 0) -> DataFrame:
    """OLS fit of y_t on 1, y_{t-1..t-p}, x_t per series via moment sums.

    Returns one row per series: coefficients (intercept, lags, regressors),
    sigma2, log-likelihood, AIC, n.
    """
    return _ar_solutions(df, keys, ts, y, xs or [], [p], d).drop("p", "d")


def ar_order_search(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str] | None = None,
                    max_p: int = 3, ds=(0, 1)) -> DataFrame:
    """Best lag order by AIC for each series and difference order.

    All lag orders of a difference order share one sample and one scan; orders
    of differencing change the target, so they are never ranked together.
    """
    from functools import reduce
    from pyspark.sql import Window
    fits = reduce(DataFrame.unionByName, [_ar_solutions(df, keys, ts, y, xs or [], list(range(1, max_p + 1)), d) for d in ds])
    w = Window.partitionBy(*keys, "d").orderBy("aic", "p")
    return fits.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def ar_forecast(df: DataFrame, fit: DataFrame, keys: list[str], ts: str, y: str, p: int, h: int = 12) -> DataFrame:
    """H-step recursive forecast (d = 0) with 95% bounds from the innovation variance."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.desc(ts)) if keys else Window.orderBy(F.desc(ts))
    last = (df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= p)  # p rows per series
              .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(ts), F.col(y).cast("double").alias("v"))))
                                  .alias("hist")))
    # one row per series on both sides (a single series joins on a constant key)
    state = (last.join(fit, keys) if keys
             else last.withColumn("_one", F.lit(1)).join(fit.withColumn("_one", F.lit(1)), "_one").drop("_one"))
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = (key_schema + ", " if keys else "") + "step int, forecast double, lower double, upper double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            beta = np.asarray(r["coef"])
            hist = [x["v"] for x in r["hist"]]
            psi = [1.0]
            var = 0.0
            for s in range(1, h + 1):
                lags = hist[::-1][:p]
                f = beta[0] + sum(beta[k + 1] * lags[k] for k in range(min(p, len(lags))))
                hist.append(f)
                # psi weights of the AR polynomial for the forecast variance
                nxt = sum(beta[k + 1] * psi[-(k + 1)] for k in range(min(p, len(psi))))
                var += psi[-1] ** 2 * r["sigma2"]
                psi.append(nxt)
                sd = math.sqrt(var)
                row = {k: r[k] for k in keys}
                row.update(step=s, forecast=f, lower=f - 1.959964 * sd, upper=f + 1.959964 * sd)
                rows.append(row)
        return pd.DataFrame(rows, columns=[*keys, "step", "forecast", "lower", "upper"])

    if keys:
        return state.groupBy(*keys).applyInPandas(run, schema)
    return state.mapInPandas(lambda it: (run(pdf) for pdf in it), schema)


def fitted_residuals(design: DataFrame, fit: DataFrame, keys: list[str], p: int, xs: list[str] | None = None):
    """Fitted values and residuals of an AR fit joined back to its design rows."""
    xs = xs or []
    reg = [F.lit(1.0)] + [F.col(f"_l{k}") for k in range(1, p + 1)] + [F.col(f"_x_{x}") for x in xs]
    j = (design.join(fit.select(*keys, "coef"), keys) if keys
         else design.withColumn("coef", fit.select("coef").scalar()))
    fitted = sum((F.col("coef")[i] * reg[i] for i in range(len(reg))), F.lit(0.0))
    return j.withColumn("fitted", fitted).withColumn("residual", F.col("_y") - F.col("fitted")).drop("coef")


# ------------------------------------------------------------------ DLM
def _dlm_filter(y, X, periods, harmonics, discount_trend, discount_seas, discount_reg, delta_v, prior_len):
    """One-step (forecast, lower, upper) of every row, and a function that continues along future regressor rows.

    The prior is the state one step before the first row, by least squares on
    the known values of the first ``prior_len`` rows; these have no forecast.
    """
    n = len(y)
    nreg = X.shape[1]
    dim = 2 + 2 * sum(len(hs) for hs in harmonics) + nreg
    G = np.zeros((dim, dim))
    G[0, 0] = G[0, 1] = G[1, 1] = 1.0
    pos, seas_idx = 2, []
    for per, hs in zip(periods, harmonics):
        for hh in hs:
            w = 2 * math.pi * hh / per
            G[pos:pos + 2, pos:pos + 2] = [[math.cos(w), math.sin(w)], [-math.sin(w), math.cos(w)]]
            seas_idx.append(pos)
            pos += 2
    G[pos:, pos:] = np.eye(nreg)
    disc = np.ones(dim)
    disc[0:2] = discount_trend
    for s in seas_idx:
        disc[s:s + 2] = discount_seas
    disc[pos:] = discount_reg

    def f_of(xrow):
        f = np.zeros(dim)
        f[0] = 1.0
        f[seas_idx] = 1.0
        f[pos:] = xrow
        return f

    def interval(f_vec, a, R, s, nu):
        f = float(f_vec @ a)
        half = t_quantile_975(nu) * math.sqrt(float(f_vec @ R @ f_vec + s))
        return f, f - half, f + half

    k0 = min(max(prior_len, dim + 1), n)
    seen, power, design = [], np.eye(dim), []
    for t in range(k0):
        power = power @ G
        if not np.isnan(y[t]):
            seen.append(t)
            design.append(f_of(X[t]) @ power)
    m, s = np.zeros(dim), 1.0
    if seen:
        design = np.array(design)
        m = np.linalg.lstsq(design, y[seen], rcond=None)[0]
        s = float(np.var(y[seen] - design @ m)) if len(seen) > 1 else 1.0
    s = max(s, 1e-8)
    C, nu = np.eye(dim) * s * 10, 1.0
    out = []
    for t in range(n):
        a = G @ m
        R = G @ C @ G.T / np.sqrt(np.outer(disc, disc))
        f_vec = f_of(X[t])
        out.append(interval(f_vec, a, R, s, delta_v * nu) if t >= k0 else (math.nan,) * 3)
        if np.isnan(y[t]):
            m, C = a, R
            continue
        e = y[t] - float(f_vec @ a)
        q = float(f_vec @ R @ f_vec + s)
        gain = R @ f_vec / q
        nu_new = delta_v * nu + 1
        s_new = s * (delta_v * nu + e * e / q) / nu_new
        m = a + gain * e
        C = (s_new / s) * (R - np.outer(gain, gain) * q)
        s, nu = s_new, nu_new

    def ahead(paths):
        a, R, W, rows = m, C, None, []
        for xrow in paths:
            a, P = G @ a, G @ R @ G.T
            if W is None:
                W = P / np.sqrt(np.outer(disc, disc)) - P
            R = P + W
            rows.append(interval(f_of(xrow), a, R, s, delta_v * nu))
        return rows
    return out, ahead


def dlm(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str] | None = None, periods=(7,),
        harmonics=((1, 2),), discounts=(0.98, 0.98, 0.98), delta_v: float = 0.98, prior_len: int = 14,
        h: int = 3, future: DataFrame | None = None, scenario: str | None = None) -> DataFrame:
    """One-step forecasts with 95% intervals, then the steps beyond each series.

    ``future`` (keys, step from 1, ``xs`` and, if named, ``scenario``) holds the
    regressors' paths: a series is filtered once and continued along each of
    its scenarios.  Without it the last regressors are held for ``h`` steps.
    Output columns: keys, scenario if named (null in sample), ts (null for
    future rows), step (0 in sample), y, forecast, lower, upper.  The rows that
    the prior is fitted on have no forecast.
    """
    xs = list(xs or [])
    tags = [scenario] if scenario else []
    fields = [f"{k} {df.schema[k].dataType.simpleString()}" for k in keys]
    fields += [f"{k} {future.schema[k].dataType.simpleString()}" for k in tags]
    schema = ", ".join([*fields, f"{ts} date, step int, y double, forecast double, lower double, upper double"])
    columns = [*keys, *tags, ts, "step", "y", "forecast", "lower", "upper"]

    def run(pdf: pd.DataFrame, paths: pd.DataFrame | None) -> pd.DataFrame:
        if pdf.empty:  # a path without a series
            return pd.DataFrame(columns=columns)
        pdf = pdf.sort_values(ts)
        yv = pdf[y].astype("float64").to_numpy()
        X = pdf[xs].astype("float64").to_numpy()
        ins, ahead = _dlm_filter(yv, X, list(periods), [list(hh) for hh in harmonics], *discounts, delta_v, prior_len)
        base = {k: pdf[k].iloc[0] for k in keys}
        rows = [{**base, ts: pdf[ts].iloc[i], "step": 0, "y": yv[i], "forecast": f, "lower": lo, "upper": hi}
                for i, (f, lo, hi) in enumerate(ins)]
        if paths is None:
            todo = [({}, np.repeat(X[-1:], h, axis=0))]
        else:
            paths = paths.sort_values("step")
            parts = paths.groupby(scenario, dropna=False) if scenario else [(None, paths)]
            todo = [({scenario: v} if scenario else {}, g[xs].astype("float64").to_numpy()) for v, g in parts]
        for tag, path in todo:
            rows += [{**base, **tag, ts: None, "step": s, "y": None, "forecast": f, "lower": lo, "upper": hi}
                     for s, (f, lo, hi) in enumerate(ahead(path), 1)]
        return pd.DataFrame(rows, columns=columns)

    by = keys or ["_series"]
    whole = lambda d: d if keys else d.withColumn("_series", F.lit(0))
    grouped = whole(df.select(*keys, ts, y, *xs).withColumn(ts, F.col(ts).cast("date"))).groupBy(*by)
    if future is None:
        return grouped.applyInPandas(lambda pdf: run(pdf, None), schema)
    paths = whole(future.select(*[F.col(c).alias(c) for c in (*keys, *tags, "step", *xs)])).groupBy(*by)  # may derive from ``df``
    return grouped.cogroup(paths).applyInPandas(lambda pdf, path: run(pdf, path), schema)


# ------------------------------------------------- count / binary DLM
def _digamma(x):
    x = np.asarray(x, dtype="float64").copy()
    acc = np.zeros_like(x)
    while True:
        small = x < 12
        if not small.any():
            break
        acc = acc - np.where(small, 1.0 / x, 0.0)
        x = np.where(small, x + 1, x)
    x2 = 1.0 / (x * x)
    return acc + np.log(x) - 0.5 / x - x2 * (1 / 12 - x2 * (1 / 120 - x2 / 252))


def _trigamma(x):
    x = np.asarray(x, dtype="float64").copy()
    acc = np.zeros_like(x)
    while True:
        small = x < 12
        if not small.any():
            break
        acc = acc + np.where(small, 1.0 / (x * x), 0.0)
        x = np.where(small, x + 1, x)
    x2 = 1.0 / (x * x)
    return acc + 1 / x + x2 / 2 + (1 / x) * x2 * (1 / 6 - x2 * (1 / 30 - x2 / 42))


def _glm_dlm_filter(y, family: str, discount: float):
    """Local level + trend on the linear predictor; conjugate update (West & Harrison ch. 14)."""
    G = np.array([[1.0, 1.0], [0.0, 1.0]])
    Fv = np.array([1.0, 0.0])
    first = float(np.nanmean(y[: min(len(y), 7)])) if len(y) else 0.0
    if family == "poisson":
        m = np.array([np.log(max(first, 0.5)), 0.0])
    else:
        p0 = min(max(first, 0.05), 0.95)
        m = np.array([np.log(p0 / (1 - p0)), 0.0])
    C = np.eye(2)
    out = []
    for obs in y:
        a = G @ m
        R = G @ C @ G.T / discount
        f = float(Fv @ a)
        q = float(Fv @ R @ Fv)
        if family == "poisson":
            al, be = 1.0 / q, np.exp(-f) / q
            mean = al / be
            lo, hi = mean - 1.96 * np.sqrt(al) / be, mean + 1.96 * np.sqrt(al) / be
        else:
            al, be = (1 + np.exp(f)) / q, (1 + np.exp(-f)) / q
            mean = al / (al + be)
            sd = np.sqrt(al * be / ((al + be) ** 2 * (al + be + 1)))
            lo, hi = mean - 1.96 * sd, mean + 1.96 * sd
        out.append((mean, max(lo, 0.0), hi))
        if np.isnan(obs):
            m, C = a, R
            continue
        if family == "poisson":
            al2, be2 = al + obs, be + 1.0
            f2, q2 = float(_digamma(al2) - np.log(be2)), float(_trigamma(al2))
        else:
            al2, be2 = al + obs, be + 1.0 - obs
            f2, q2 = float(_digamma(al2) - _digamma(be2)), float(_trigamma(al2) + _trigamma(be2))
        RF = R @ Fv
        m = a + RF * (f2 - f) / q
        C = R - np.outer(RF, RF) * (1 - q2 / q) / q
    return out


def count_dlm(df: DataFrame, keys: list[str], ts: str, y: str, family: str = "poisson",
              discount: float = 0.95) -> DataFrame:
    """One-step forecasts of a count (Poisson) or 0/1 (Bernoulli) series with a dynamic model.

    Each series is filtered in ``groupBy(keys).applyInPandas`` (sequential by
    nature, one task per series); outputs the predictive mean and a 95% band.
    """
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = (key_schema + ", " if keys else "") + f"{ts} date, y double, mean double, lower double, upper double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        yv = pdf[y].astype("float64").to_numpy()
        res = _glm_dlm_filter(yv, family, discount)
        base = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([{**base, ts: pdf[ts].iloc[i], "y": yv[i], "mean": r[0], "lower": r[1], "upper": r[2]}
                             for i, r in enumerate(res)], columns=[*keys, ts, "y", "mean", "lower", "upper"])

    src = df.select(*keys, F.col(ts).cast("date").alias(ts), F.col(y).cast("double").alias(y))
    return src.groupBy(*keys).applyInPandas(run, schema)
