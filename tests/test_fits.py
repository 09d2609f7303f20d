"""Fits over many rows: how often they pass over the rows, and what they find."""

import numpy as np
from pyspark.ml.clustering import GaussianMixture, KMeans

from custos.functions.optim import newton_minimize
from custos.operators import clv, ml, ward


def test_newton_passes_over_the_rows_about_once_an_iteration():
    passes = []

    def valley(points):
        passes.append(len(points))
        return np.exp(points[:, 0]) - 2.0 * points[:, 0] + (points[:, 1] - points[:, 0]) ** 2
    best, value, iterations = newton_minimize(valley, [5.0, -3.0], tol=1e-12)
    assert np.allclose(best, np.log(2.0), atol=1e-4) and np.isclose(value, 2.0 - 2.0 * np.log(2.0))
    assert iterations > 3 and len(passes) <= iterations + 2


def test_sums_over_rows_take_one_job_of_one_stage(spark):
    rows = spark.range(0, 1000, 1, 5).selectExpr("cast(id as double) as x", "cast(id % 7 as double) as m").persist()
    rows.count()
    points = np.array([[0.0], [1.0]])
    sc = spark.sparkContext
    sc.setJobGroup("sums", "sums")
    got = clv._summed(rows, ("x", "m"), lambda p, x, m: np.exp(p[:, 0]) * (x @ m), points)
    jobs = sc.statusTracker().getJobIdsForGroup("sums")
    sc.setLocalProperty("spark.jobGroup.id", None)
    want = sum(i * (i % 7) for i in range(1000))
    assert np.allclose(got, [want, np.e * want])
    assert len(jobs) == 1 and len(sc.statusTracker().getJobInfo(jobs[0]).stageIds) == 1
    assert np.allclose(clv._summed(rows.where("x < 0"), ("x", "m"), lambda p, x, m: np.exp(p[:, 0]) * (x @ m), points), 0.0)
    rows.unpersist()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def blobs(spark, n=600):
    rng = np.random.default_rng(4)
    x = np.repeat([[0.0, 0.0], [6.0, 1.0], [1.0, 7.0]], n // 3, 0) + rng.normal(size=(n, 2))
    rows = [(int(i), float(a), float(b)) for i, (a, b) in enumerate(x)] + [(n, None, 1.0), (n + 1, 2.0, float("nan"))]
    return spark.createDataFrame(rows, "i int, a double, b double")


def test_mixture_equals_that_of_spark(spark):
    df = blobs(spark)
    lab, m = ml.gmm(df, ["a", "b"], 3)
    data = ml.assemble(df, ["a", "b"])
    want = GaussianMixture(k=3, seed=1, featuresCol="features").fit(data)
    assert np.allclose(m.weights, want.weights)
    assert np.allclose(m.means, [g["mean"].toArray() for g in want.gaussiansDF.collect()])
    assert np.allclose(m.covs, [g["cov"].toArray() for g in want.gaussiansDF.collect()])
    got = {r["i"]: (r["cluster"], r["probability"].toArray()) for r in lab.collect()}
    for r in want.transform(data).collect():
        assert got[r["i"]][0] == r["prediction"] and np.allclose(got[r["i"]][1], r["probability"].toArray())
    assert len(got) == 600
    assert "ArrowEvalPython" in plan(lab.select("cluster"))  # rows are labelled in batches


def test_micro_clusters_are_those_of_spark(spark):
    df = blobs(spark).where("i < 600").select("a", "b")
    want = KMeans(k=20, seed=1, featuresCol="features").fit(ml.assemble(df, ["a", "b"]))
    tree = ward.ward_tree(df, ["a", "b"], micro=20)
    sizes = want.transform(ml.assemble(df, ["a", "b"])).groupBy("prediction").count().collect()
    assert sorted(tree.sizes) == sorted(r["count"] for r in sizes)
    near = ((tree.centres[:, None] - np.array(want.clusterCenters())[None]) ** 2).sum(2).min(1)
    assert near.max() < 0.05  # a tree's centre is the mean of its rows, Spark's that of an iteration before


def test_ward_labels_take_columns_not_a_list_a_row(spark):
    df = blobs(spark)
    out = ward.ward_tree(df, ["a", "b"], micro=20).label(df, ["a", "b"], 3)
    assert "array(" not in plan(out)
    assert [r["i"] for r in out.where("cluster is null").orderBy("i").collect()] == [600, 601]
