"""Rank passes over all columns at once: describe, extended describe, exact quantiles."""

import numpy as np
import pandas as pd
import pytest

from custos.operators import stats


def table(spark, n=600):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": np.round(rng.normal(size=n), 1), "b": rng.exponential(1e6, n), "c": np.full(n, 3.0),
                        "d": np.where(rng.random(n) < 0.3, np.nan, rng.integers(-5, 5, n))})
    rows = [[None if v != v else float(v) for v in r] for r in pdf.to_numpy()]
    return pdf, spark.createDataFrame([(*r, None) for r in rows], "a double, b double, c double, d double, e double")


def test_describe_equals_pandas_for_every_column(spark):
    pdf, df = table(spark)
    got = stats.describe(df, list("abcde")).toPandas().pivot(index="stat", columns="column_name", values="value")
    want = pdf.describe()
    for c in "abcd":
        assert np.allclose(got[c].reindex(want.index), want[c], rtol=1e-9, atol=1e-6)
    assert got["e"]["count"] == 0 and got["e"].drop("count").isna().all()


def test_extended_describe_equals_plain_formulas(spark):
    pdf, df = table(spark)
    got = stats.describe_extended(df, list("abcde")).toPandas().set_index("column_name")
    for c in "abd":
        x = np.sort(pdf[c].dropna().to_numpy())
        n, k, d = len(x), int(len(x) * 0.1), x - x.mean()
        assert got.n[c] == n
        assert np.isclose(got["median"][c], np.median(x), atol=1e-6)
        assert np.isclose(got.trimmed[c], x[k:n - k].mean(), atol=1e-5)
        assert np.isclose(got["mad"][c], 1.4826 * np.median(np.abs(x - np.median(x))), atol=1e-5)
        assert np.isclose(got["skew"][c], (d ** 3).mean() / (d ** 2).mean() ** 1.5 * (1 - 1 / n) ** 1.5, atol=1e-5)
    assert got["mad"]["c"] == 0 and got.trimmed["c"] == 3 and got.n["e"] == 0 and got["median"].isna()["e"]


@pytest.mark.parametrize("op", [stats.describe, stats.describe_extended])
def test_jobs_do_not_grow_with_the_columns(spark, op):
    _, df = table(spark, 50)
    df = df.cache()
    df.count()
    sc, jobs = spark.sparkContext, []
    for cols in (["a"], list("abd")):
        group = f"{op.__name__}-{len(cols)}"
        sc.setJobGroup(group, group)
        op(df, cols)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(group)))
    sc.setJobGroup("rest", "rest")
    assert jobs[0] == jobs[1] > 0


def test_quantiles_of_hot_null_and_empty_groups(spark):
    rows = [("hot", float(i % 977)) for i in range(5000)] + [(None, 1.0), (None, 2.0), ("one", 7.0), ("none", None)]
    q = stats.exact_quantiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", [0.25, 0.5], ["l", "m"])
    got = {r["k"]: (r["l"], r["m"]) for r in q.collect()}
    hot = np.quantile([i % 977 for i in range(5000)], [0.25, 0.5])
    assert got == {"hot": tuple(hot), None: (1.25, 1.5), "one": (7.0, 7.0), "none": (None, None)}
    empty = stats.exact_quantiles(spark.createDataFrame([], "k string, x double"), [], "x", [0.5], ["m"])
    assert [r["m"] for r in empty.collect()] == [None]
