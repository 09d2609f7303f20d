"""Models on tables (M1-M34, C12) with pyspark.ml.

Fits are MLlib estimators (distributed gradient / EM / tree aggregation);
only fitted parameters (centres, coefficients) come back to the driver.
Everything that scores rows is a ``transform`` or a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custos.functions.special import norm_cdf_col
from custos.operators.neighbours import nearest


# ------------------------------------------------------------- preparation
def zscale(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population sd, one aggregate pass."""
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    out = df
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - stats.select(f"m_{c}").scalar())
                             / stats.select(f"s_{c}").scalar())
    return out


def minmax(df: DataFrame, cols: list[str], suffix: str = "_mm") -> DataFrame:
    """(x - min) / (max - min)."""
    out = df
    for c in cols:
        lo, hi = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
        out = out.withColumn(f"{c}{suffix}", F.try_divide((F.col(c) - lo).cast("double"), (hi - lo).cast("double")))
    return out


def one_hot(df: DataFrame, col: str, prefix: str = "Category_") -> DataFrame:
    """M1: one 0/1 column per level (levels are read once; their number is the category count)."""
    levels = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]
    return df.select("*", *[F.when(F.col(col) == lv, 1).otherwise(0).alias(f"{prefix}{lv}") for lv in levels])


def hash_split(df: DataFrame, key: str, frac: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M2: reproducible split by a hash of the key (independent of partitioning)."""
    u = (F.abs(F.xxhash64(F.col(key), F.lit(seed))) % 1_000_000) / 1_000_000.0
    return df.where(u < frac), df.where(u >= frac)


def stratified_split(df: DataFrame, key: str, label: str, frac: float = 0.7, seed: int = 42):
    """M3: per class, the first ceil(frac * n_class) rows by key hash go to training."""
    h = F.xxhash64(F.col(key), F.lit(seed))
    w = Window.partitionBy(label).orderBy(h, key)
    n = F.count("*").over(Window.partitionBy(label))
    ranked = df.withColumn("_r", F.row_number().over(w)).withColumn("_cut", F.ceil(n * frac))
    return (ranked.where(F.col("_r") <= F.col("_cut")).drop("_r", "_cut"),
            ranked.where(F.col("_r") > F.col("_cut")).drop("_r", "_cut"))


def chrono_split(df: DataFrame, ts: str, frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """M4: first frac of rows in time order vs the rest (dense index computed in parallel)."""
    from custos.operators.layout import dense_index
    idx = dense_index(df, [ts])
    cut = F.floor(df.agg(F.count("*")).scalar() * frac)
    return idx.where(F.col("idx") < cut).drop("idx"), idx.where(F.col("idx") >= cut).drop("idx")


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip").transform(df)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deal the rows over more tasks where cached parts would hold more than ``rows`` on average over the cores."""
    need = -(-df.count() // rows)
    return df.repartition(need) if need > df.sparkSession.sparkContext.defaultParallelism else df


# --------------------------------------------------------------- clustering
def kmeans(df: DataFrame, cols: list[str], k: int, restarts: int = 1, max_iter: int = 150, seed: int = 1):
    """M5: k-means with restarts (best training cost); returns (labelled rows, model)."""
    data = assemble(df, cols).persist()
    best = None
    for r in range(restarts):
        m = KMeans(k=k, maxIter=max_iter, seed=seed + r, featuresCol="features").fit(data)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    out = best.transform(data).withColumnRenamed("prediction", "cluster")
    return out, best


def within_ss(data: DataFrame, cols: list[str], k: int, seed: int = 1) -> float:
    """Within-cluster sum of squares of k-means; the total one for a single cluster."""
    if k > 1:
        return float(KMeans(k=k, seed=seed, featuresCol="features").fit(data).summary.trainingCost)
    ss = data.agg(*[F.var_pop(F.col(c).cast("double")) * F.count("*") for c in cols]).first()
    return float(sum(ss))


def elbow(df: DataFrame, cols: list[str], k_max: int = 10, seed: int = 1) -> DataFrame:
    """M6: total within-cluster sum of squares for k = 1..k_max."""
    data = assemble(df.select(*cols), cols).persist()  # only what the fits read is kept
    rows = [(k, within_ss(data, cols, k, seed)) for k in range(1, k_max + 1)]
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, wss double")


GMM_ITERATIONS, GMM_TOL, GMM_EPS = 100, 0.01, 2.0 ** -52  # Spark's defaults and its least density


@dataclass
class Mixture:
    """Weights, means and covariances of a Gaussian mixture."""
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray

    def densities(self, x: np.ndarray) -> np.ndarray:
        """Weighted density of each component (rows) at each column of ``x``; directions without variance do not count."""
        out = np.empty((len(self.weights), x.shape[1]))
        for j, (w, mean, cov) in enumerate(zip(self.weights, self.means, self.covs)):
            values, axes = np.linalg.eigh(cov)
            real = values > GMM_EPS * values.max() * len(values)
            if not real.any():
                raise ValueError("a component has no variance")
            scale = np.where(real, 1.0 / np.sqrt(np.where(real, values, 1.0)), 0.0)
            y = (axes * scale).T @ (x - mean[:, None])
            at_mean = -0.5 * (len(mean) * np.log(2.0 * np.pi) + np.log(values[real]).sum())
            out[j] = GMM_EPS + w * np.exp(at_mean - 0.5 * (y * y).sum(0))
        return out

    def moments(self, x: np.ndarray) -> np.ndarray:
        """Of the columns of ``x``: log-likelihood, then per component the sums of its shares, of x and of x x'."""
        p = self.densities(x)
        total = p.sum(0)
        p /= total
        squares = [(x * share) @ x.T for share in p]
        return np.concatenate([[np.log(total).sum()], p.sum(1), (p @ x.T).ravel(), np.ravel(squares)])


def gmm(df: DataFrame, cols: list[str], k: int, seed: int = 1):
    """M7: Gaussian mixture, label = max posterior; (labelled rows, mixture).

    The start is Spark's; every iteration is one pass over the kept columns,
    in which tasks sum the moments of their rows batch by batch.
    """
    data = assemble(df, cols)
    rows = data.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).persist()
    start = GaussianMixture(k=k, seed=seed, maxIter=0, featuresCol="features").fit(assemble(rows, rows.columns).select("features"))
    at = start.gaussiansDF.collect()
    m = Mixture(np.array(start.weights), np.array([g["mean"].toArray() for g in at]), np.array([g["cov"].toArray() for g in at]))
    d, before, now = len(cols), 0.0, -np.finfo(float).max
    for _ in range(GMM_ITERATIONS):
        if abs(now - before) <= GMM_TOL:
            break
        before, (now, s) = now, _moments(rows, m)
        n, x, xx = s[:k], s[k:k + k * d].reshape(k, d), s[k + k * d:].reshape(k, d, d)
        means = x / n[:, None]
        m = Mixture(n / n.sum(), means, xx / n[:, None, None] - means[:, :, None] * means[:, None, :])
    rows.unpersist()

    @F.pandas_udf("array<double>")
    def posterior(*columns: pd.Series) -> pd.Series:
        p = m.densities(np.stack([c.to_numpy(float) for c in columns]))
        return pd.Series(list((p / p.sum(0)).T))

    @F.pandas_udf("int")
    def label(*columns: pd.Series) -> pd.Series:
        return pd.Series(m.densities(np.stack([c.to_numpy(float) for c in columns])).argmax(0).astype("int32"))
    num = [F.col(c).cast("double") for c in cols]
    return data.withColumn("cluster", label(*num)).withColumn("probability", array_to_vector(posterior(*num))), m


def _moments(rows: DataFrame, m: Mixture) -> tuple[float, np.ndarray]:
    """Log-likelihood and moment sums of all rows: one row of sums a task is added up here."""
    def run(parts):
        yield pd.DataFrame({"s": [sum((m.moments(np.ascontiguousarray(p.to_numpy(float).T)) for p in parts), 0.0) + np.zeros(m.covs.size + m.means.size + m.weights.size + 1)]})
    total = np.sum([r["s"] for r in rows.mapInPandas(run, "s array<double>").collect()], axis=0)
    return float(total[0]), total[1:]


def hierarchical(df: DataFrame, cols: list[str], k: int, seed: int = 1):
    """M8 (re-aimed): divisive bisecting k-means instead of an O(n^2) Ward tree."""
    data = assemble(df, cols)
    m = BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(data)
    return m.transform(data).withColumnRenamed("prediction", "cluster"), m


def silhouette(labelled: DataFrame, cluster: str = "cluster") -> float | None:
    """M9: mean silhouette (squared Euclidean, MLlib's distributed form); None for one cluster."""
    if labelled.select(cluster).distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(featuresCol="features", predictionCol=cluster).evaluate(labelled)


def gap_statistic(df: DataFrame, cols: list[str], k_max: int = 10, b: int = 10, seed: int = 1) -> DataFrame:
    """Gap(k) = mean_b ln W_kb - ln W_k with uniform reference sets over the column ranges."""
    import math
    df = df.select(*cols).persist()  # only what the fits read is kept
    data = assemble(df, cols).persist()
    n = data.count()
    bounds = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                    *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    spark = df.sparkSession
    log_refs = [[] for _ in range(k_max)]
    for j in range(b):
        ref = assemble(spark.range(n).select(*[
            (F.lit(bounds[f"lo{i}"]) + F.rand(seed * 1000 + j * 31 + i) * (bounds[f"hi{i}"] - bounds[f"lo{i}"]))
            .alias(c) for i, c in enumerate(cols)]), cols).persist()
        for k in range(1, k_max + 1):
            log_refs[k - 1].append(math.log(within_ss(ref, cols, k, seed)))
        ref.unpersist()
    rows = []
    for k, refs in enumerate(log_refs, 1):
        mean_ref = sum(refs) / b
        sd = (sum((r - mean_ref) ** 2 for r in refs) / b) ** 0.5
        rows.append((k, mean_ref - math.log(within_ss(data, cols, k, seed)), sd * (1 + 1 / b) ** 0.5))
    data.unpersist()
    df.unpersist()
    return spark.createDataFrame(rows, "k int, gap double, s double")


def kprototypes(df: DataFrame, num_cols: list[str], cat_cols: list[str], k: int, iters: int = 20,
                lam: float | None = None, seed: int = 1) -> tuple[DataFrame, list]:
    """K-prototypes (squared distance + lambda x mismatches).

    Centres (k rows) are broadcast as literals; each iteration assigns by a
    column expression and updates by ``avg`` + per-cluster mode.  The rows are
    cached before the loop, so what they are joined from is broadcast once.
    """
    df = df.persist()  # every iteration reads the rows, not the joins they come from
    if lam is None:
        var = df.agg(*[F.var_pop(c) for c in num_cols]).first()
        lam = float(sum(v or 0 for v in var) / max(len(num_cols), 1)) or 1.0
    init = df.orderBy(F.xxhash64(*[F.col(c) for c in num_cols + cat_cols], F.lit(seed))).limit(k).collect()
    centres = [([float(r[c]) for c in num_cols], [r[c] for c in cat_cols]) for r in init]
    cur = df
    for _ in range(iters):
        dists = []
        for j, (cn, cc) in enumerate(centres):
            d = sum(((F.col(c) - cn[i]) ** 2 for i, c in enumerate(num_cols)), F.lit(0.0))
            d = d + lam * sum((F.when(F.col(c) == cc[i], 0).otherwise(1) for i, c in enumerate(cat_cols)), F.lit(0))
            dists.append(F.struct(d.alias("d"), F.lit(j).alias("j")))
        cur = df.withColumn("cluster", F.least(*dists)["j"])
        num = cur.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in num_cols]).collect()
        new = {r["cluster"]: [float(r[c]) for c in num_cols] for r in num}
        modes = {}
        for c in cat_cols:
            w = Window.partitionBy("cluster").orderBy(F.desc("n"), c)
            m = (cur.groupBy("cluster", c).agg(F.count("*").alias("n")).withColumn("_r", F.row_number().over(w))
                    .where("_r = 1").collect())
            for r in m:
                modes.setdefault(r["cluster"], {})[c] = r[c]
        updated = [(new.get(j, cn), [modes.get(j, {}).get(c, cc[i]) for i, c in enumerate(cat_cols)])
                   for j, (cn, cc) in enumerate(centres)]
        if updated == centres:
            break
        centres = updated
    return cur, centres


def pca(df: DataFrame, cols: list[str], k: int = 1) -> DataFrame:
    """Principal component scores of centred data."""
    centred = df
    for c in cols:
        centred = centred.withColumn(c, F.col(c) - df.agg(F.avg(c)).scalar())
    data = assemble(centred, cols)
    m = PCA(k=k, inputCol="features", outputCol="pcs").fit(data)
    return m.transform(data).withColumn("pc", vector_to_array("pcs"))


def famd(df: DataFrame, num_cols: list[str], cat_cols: list[str], k: int = 2) -> DataFrame:
    """Z-scaled numerics + one-hot factors scaled by 1/sqrt(p), then PCA."""
    out = zscale(df, num_cols)
    oh_cols = []
    for c in cat_cols:
        before = set(out.columns)
        out = one_hot(out, c, prefix=f"{c}_")
        new_cols = [x for x in out.columns if x not in before]
        for nc in new_cols:
            p = out.agg(F.avg(nc)).first()[0] or 1.0
            out = out.withColumn(nc, F.col(nc) / F.sqrt(F.lit(p)))
        oh_cols += new_cols
    return pca(out, [f"{c}_z" for c in num_cols] + oh_cols, k)


# ------------------------------------------------------- supervised models
def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes x n_class) per row."""
    n = df.agg(F.count("*")).scalar()
    k = df.agg(F.count_distinct(label)).scalar()
    per = df.groupBy(label).agg(F.count("*").alias("_nc"))
    return df.join(per, label).withColumn(out, n / (k * F.col("_nc"))).drop("_nc")


def logistic(df: DataFrame, features: list[str], label: str, c: float = 1.0, balanced: bool = False):
    """L2 logistic regression, regParam = 1/(C n)."""
    data = assemble(df, features)
    if balanced:
        data = balanced_weights(data, label)
    n = data.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
                            weightCol="weight" if balanced else None)
    return lr.fit(data), data


def glm_table(df: DataFrame, features: list[str], label: str, family: str = "binomial") -> DataFrame:
    """Coefficient table with standard error, z (t), p-value, plus AIC."""
    data = assemble(df, features)
    link = {"binomial": "logit", "poisson": "log"}.get(family, "identity")
    m = GeneralizedLinearRegression(family=family, link=link, featuresCol="features", labelCol=label).fit(data)
    s = m.summary
    names = features + ["intercept"]
    coefs = list(m.coefficients) + [m.intercept]
    rows = [(n_, float(b), float(se), float(t), float(p), float(s.aic))
            for n_, b, se, t, p in zip(names, coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, z double, p double, aic double")


def multinomial_table(df: DataFrame, features: list[str], label: str, reference: str) -> DataFrame:
    """Multinomial logit relative to a reference class, odds ratios.

    Standard errors come from the Hessian of the multinomial likelihood,
    accumulated as one distributed aggregate over rows (sum of x x' p(1-p)
    blocks); the (classes x features)^2 solve happens on the driver.
    """
    import numpy as np
    idx = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(df)
    data = assemble(idx.transform(df), features)
    m = LogisticRegression(featuresCol="features", labelCol="_y", family="multinomial", regParam=0.0).fit(data)
    labels = idx.labels
    ref = labels.index(reference)
    B = m.coefficientMatrix.toArray()
    b0 = m.interceptVector.toArray()
    B, b0 = B - B[ref], b0 - b0[ref]
    p = len(features) + 1
    others = [j for j in range(len(labels)) if j != ref]
    # Hessian blocks: sum_i (diag(pi) - pi pi') kron x_i x_i'
    probs = m.transform(data).select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("pr"))
    K = len(others)
    dim = K * p
    hcols = []
    for a in range(K):
        for bb in range(K):
            ja, jb = others[a], others[bb]
            w = (F.col("pr")[ja] * ((1.0 if a == bb else 0.0) - F.col("pr")[jb]))
            for u in range(p):
                xu = F.lit(1.0) if u == p - 1 else F.col("x")[u]
                for v in range(p):
                    xv = F.lit(1.0) if v == p - 1 else F.col("x")[v]
                    hcols.append(F.sum(w * xu * xv))
    hv = np.array(probs.agg(*hcols).first(), dtype="float64").reshape(K, K, p, p)
    H = hv.transpose(0, 2, 1, 3).reshape(dim, dim)
    se = np.sqrt(np.clip(np.diag(np.linalg.pinv(H)), 0, None))
    rows = []
    for a, j in enumerate(others):
        for u in range(p):
            coef = float(b0[j]) if u == p - 1 else float(B[j, u])
            s = float(se[a * p + u])
            z = coef / s if s > 0 else float("nan")
            rows.append((labels[j], "intercept" if u == p - 1 else features[u], coef, s, z))
    out = df.sparkSession.createDataFrame(rows, "class string, term string, coef double, se double, z double")
    return (out.withColumn("p", 2 * (1 - norm_cdf_col(F.abs("z"))))
               .withColumn("odds_ratio", F.exp("coef")))


FOREST_ROWS = 100_000  # rows of a cached part of 50 trees


def forest(df: DataFrame, features: list[str], label: str, trees: int = 100, balanced: bool = False,
           seed: int = 42):
    """Random-forest classifier (sqrt feature subset); returns (model, importances)."""
    data = assemble(df, features)
    if balanced:
        data = balanced_weights(data, label)
    # each tree counts every cached row: about 1 KB a row for 50 trees, so the parts are kept small
    data = spread(data.select("features", label, *(["weight"] if balanced else [])), FOREST_ROWS * 50 // max(trees, 1))
    m = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, seed=seed,
                               featureSubsetStrategy="sqrt", weightCol="weight" if balanced else None).fit(data)
    return m, importances(df.sparkSession, features, m.featureImportances)


def forest_regression_importance(df: DataFrame, features: list[str], label: str, trees: int = 300, seed: int = 42):
    """M23."""
    data = assemble(df, features)
    m = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, seed=seed).fit(data)
    return importances(df.sparkSession, features, m.featureImportances)


def importances(spark, names: list[str], vec) -> DataFrame:
    """Importance table sorted descending (O3)."""
    rows = [(n, float(vec[i])) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def cluster_validation(df: DataFrame, features: list[str], cluster: str, folds: int = 10, trees: int = 50,
                       seed: int = 42):
    """Predict the cluster from other columns with a cross-validated forest."""
    idx = StringIndexer(inputCol=cluster, outputCol="_y").fit(df)
    data = assemble(idx.transform(df), features)
    rf = RandomForestClassifier(featuresCol="features", labelCol="_y", seed=seed)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [trees]).build()
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, numFolds=folds, seed=seed,
                        evaluator=MulticlassClassificationEvaluator(labelCol="_y", metricName="accuracy"))
    m = cv.fit(data)
    return m, float(m.avgMetrics[0])


def binary_auc(pred: DataFrame, label: str, score_col: str = "probability") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score_col).evaluate(pred)


SEGMENT_ROWS = 500_000  # rows of a cached part


def segment(df: DataFrame, num_cols: list[str], k: int, algo: str = "kmeans", comps: int = 2, seed: int = 1):
    """Reduce (PCA) -> cluster -> silhouette and per-cluster profile."""
    red = pca(df, num_cols, comps).withColumn("_pcs", F.col("pc"))
    feats = [f"pc{i}" for i in range(comps)]
    for i in range(comps):
        red = red.withColumn(f"pc{i}", F.col("_pcs")[i])
    red = spread(red.select(*df.columns, *feats), SEGMENT_ROWS)
    if algo == "kmeans":
        lab, _ = kmeans(red, feats, k, seed=seed)
    elif algo == "gmm":
        lab, _ = gmm(red, feats, k, seed=seed)
    else:
        lab, _ = hierarchical(red, feats, k, seed=seed)
    sil = silhouette(lab)
    prof = lab.groupBy("cluster").agg(F.count("*").alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in num_cols])
    return lab, prof, sil


def rfm_segments(rfm: DataFrame, cap: float, k: int = 3, seed: int = 1):
    """K-means on z-scaled R, F, M (monetary < cap); clusters ranked by mean recency."""
    kept = rfm.where(F.col("monetary_value") < cap)
    z = zscale(kept, ["recency", "frequency", "monetary_value"])
    lab, _ = kmeans(z, ["recency_z", "frequency_z", "monetary_value_z"], k, max_iter=150, seed=seed)
    prof = lab.groupBy("cluster").agg(F.avg("recency").alias("recency"), F.avg("frequency").alias("frequency"),
                                      F.avg("monetary_value").alias("monetary_value"))
    prof = prof.withColumn("new_cl_id", (F.row_number().over(Window.orderBy("recency", "cluster")) - 1).cast("int"))
    return lab.select("customer_id", "recency", "frequency", "monetary_value", "cluster"), prof


_ = (Pipeline, OneHotEncoder)


# --------------------------------------------------- nearest-neighbour helpers
def nearest_distance(queries: DataFrame, corpus: DataFrame, cols: list[str], qid: str, cid: str | None = None,
                     max_queries: int = 20000) -> DataFrame:
    """Exact Euclidean distance from each query point to its nearest corpus row, by cells (``neighbours.nearest``).

    At most about ``max_queries`` queries of a cell meet its points in one task.
    With ``cid`` a query never matches the corpus row with the same id
    (self-distance excluded).  Corpus rows with a null take no part; the distance
    of a query with a null is not a number.
    """
    return nearest(queries, corpus, cols, qid, cid, max_queries)


def hopkins(df: DataFrame, cols: list[str], id_col: str, fraction: float = 0.1, seed: int = 42) -> float:
    """H = sum u / (sum u + sum w); u from uniform points, w from sampled rows (hash sample)."""
    sample = df.where((F.abs(F.xxhash64(F.col(id_col), F.lit(seed))) % 1_000_000) < fraction * 1_000_000) \
               .select(id_col, *cols)
    m = sample.count()
    b = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    unif = df.sparkSession.range(m).select(
        F.col("id").alias("_uid"),
        *[(F.lit(b[f"lo_{c}"]) + F.rand(seed + i) * (b[f"hi_{c}"] - b[f"lo_{c}"])).alias(c) for i, c in enumerate(cols)])
    w = nearest_distance(sample, df.select(id_col, *cols), cols, id_col, id_col).agg(F.sum("nn_distance")).first()[0]
    u = nearest_distance(unif, df.select(*cols), cols, "_uid").agg(F.sum("nn_distance")).first()[0]
    return float(u / (u + w))


def factor_analysis(df: DataFrame, cols: list[str], n_factors: int, iters: int = 50, rotate: bool = True):
    """Eigenvalues and (principal-axis) loadings with varimax, from the distributed correlation matrix.

    Only the p x p correlation matrix reaches the driver.
    """
    import numpy as np
    spark = df.sparkSession
    p = len(cols)
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{i}_{j}")
                   for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]).first()
    Rm = np.eye(p)
    for i in range(p):
        for j in range(i + 1, p):
            Rm[i, j] = Rm[j, i] = row[f"c_{i}_{j}"]
    eig = np.sort(np.linalg.eigvalsh(Rm))[::-1]
    h2 = 1 - 1 / np.diag(np.linalg.pinv(Rm))       # squared multiple correlations
    for _ in range(iters):                           # iterated principal axis
        Rr = Rm.copy()
        np.fill_diagonal(Rr, h2)
        w, v = np.linalg.eigh(Rr)
        order = np.argsort(w)[::-1][:n_factors]
        L = v[:, order] * np.sqrt(np.maximum(w[order], 0))
        h2 = (L ** 2).sum(1)
    if rotate and n_factors > 1:
        L = _varimax(L)
    loadings = spark.createDataFrame([(c, *[float(x) for x in L[i]]) for i, c in enumerate(cols)],
                                     ["variable", *[f"factor{k + 1}" for k in range(n_factors)]])
    eigen = spark.createDataFrame([(i + 1, float(e)) for i, e in enumerate(eig)], "component int, eigenvalue double")
    return loadings, eigen


def _varimax(L, gamma: float = 1.0, iters: int = 100, tol: float = 1e-8):
    import numpy as np
    p, k = L.shape
    R = np.eye(k)
    d = 0.0
    for _ in range(iters):
        Lr = L @ R
        u, s, vt = np.linalg.svd(L.T @ (Lr ** 3 - (gamma / p) * Lr @ np.diag((Lr ** 2).sum(0))))
        R = u @ vt
        d_new = s.sum()
        if d_new < d * (1 + tol):
            break
        d = d_new
    return L @ R


# ----------------------------------------------------- normalising transforms
def _norm_ppf(p: float) -> float:
    """Inverse standard normal CDF (Acklam's rational approximation, |error| < 1.2e-9)."""
    import math
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        return (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    if p > 1 - lo:
        return -_norm_ppf(1 - p)
    q = p - 0.5
    r = q * q
    return (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)


def _ppf_col(p):
    """Native inverse-normal approximation (central region rational form + tail form)."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]

    def tail(pp):
        q = F.sqrt(-2 * F.log(pp))
        return (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    q = p - 0.5
    r = q * q
    central = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)
    return F.when(p < 0.02425, tail(p)).when(p > 1 - 0.02425, -tail(1 - p)).otherwise(central)


def _lam_name(lam: float) -> str:
    return str(lam).replace("-", "m").replace(".", "p")


def best_normalize(df: DataFrame, col: str, lambdas=(-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0)) -> DataFrame:
    """Score candidate normalising transforms by Pearson chi-square / df (lower is better).

    Candidates: identity, log, sqrt (positive data), arcsinh, Box-Cox and
    Yeo-Johnson over a lambda grid, and the rank-normal (ordered quantile)
    transform whose ranks come from the parallel prefix sums.  Each candidate
    is standardised and binned into equiprobable normal bins, whose number grows
    with the rows: every task counts its rows by binary search in the bounds, so
    the plan does not grow with them.
    """
    import math

    import numpy as np
    import pandas as pd
    from custos.operators.layout import prefix_sums
    x = F.col(col).cast("double")
    base = df.select(x.alias("x")).where(F.col("x").isNotNull())
    n = base.count()
    lo = base.agg(F.min("x")).first()[0]
    cands = {"identity": F.col("x"), "arcsinh": F.asinh("x")}
    if lo is not None and lo > 0:
        cands["log"] = F.log("x")
        cands["sqrt"] = F.sqrt("x")
        for lam in lambdas:
            cands[f"boxcox_{_lam_name(lam)}"] = F.log("x") if lam == 0 else (F.pow("x", lam) - 1) / lam
    for lam in lambdas:
        pos = F.log1p("x") if lam == 0 else (F.pow(F.col("x") + 1, lam) - 1) / lam
        neg = -F.log1p(-F.col("x")) if lam == 2 else -(F.pow(1 - F.col("x"), 2 - lam) - 1) / (2 - lam)
        cands[f"yeojohnson_{_lam_name(lam)}"] = F.when(F.col("x") >= 0, pos).otherwise(neg)
    # rank-normal: average ranks of ties from cumulative counts over distinct values
    counts = prefix_sums(base.groupBy("x").agg(F.count("*").alias("c")), ["x"], ["c"])
    ranks = counts.select("x", ((F.col("cum_c") - F.col("c") + 1 + F.col("cum_c")) / 2.0).alias("rank"))
    base = base.join(ranks, "x")
    cands["rank_normal"] = _ppf_col((F.col("rank") - 0.5) / n)
    bins = max(3, int(math.ceil(2 * n ** 0.4)))
    bounds = [_norm_ppf(i / bins) for i in range(1, bins)]
    t = base.select(*[c.alias(k) for k, c in cands.items()])
    stats = t.agg(*[F.avg(k).alias(f"m_{k}") for k in cands], *[F.stddev_samp(k).alias(f"s_{k}") for k in cands]).first()
    fits = {k: (stats[f"m_{k}"], stats[f"s_{k}"]) for k in cands if stats[f"m_{k}"] is not None and stats[f"s_{k}"]}
    if not fits:
        return df.sparkSession.createDataFrame([], "transform string, chi2_df double")

    def binned(parts):
        counts = np.zeros((len(fits), bins), np.int64)
        for part in parts:
            for i, (k, (m, s)) in enumerate(fits.items()):
                at = np.searchsorted(bounds, (part[k].to_numpy("float64") - m) / s)  # bounds below z
                counts[i] += np.bincount(at, minlength=bins)
        row, at = np.nonzero(counts)
        yield pd.DataFrame({"transform": np.array(list(fits), object)[row], "bin": at, "o": counts[row, at]})
    e = n / bins
    obs = t.select(*fits).mapInPandas(binned, "transform string, bin long, o long").groupBy("transform", "bin").agg(F.sum("o").alias("o"))
    # sum (O-E)^2/E over all bins = sum O^2/E - n (empty bins need no row)
    return (obs.groupBy("transform").agg(((F.sum(F.col("o") * F.col("o")) / e - n) / (bins - 1)).alias("chi2_df"))
               .orderBy("chi2_df"))


# ------------------------------------------------------ low-rank model
def glrm(df: DataFrame, id_col: str, cols: list[str], k: int = 2, gamma_x: float = 0.25, gamma_y: float = 1.0,
         iters: int = 30):
    """Quadratic-loss low-rank model with L1 on both factors, by alternating proximal steps.

    A = standardised columns; X (n x k) lives in the DataFrame, Y (k x p) on the
    driver (its size is k x p).  The X step is a column expression with Y as
    literals; the Y step needs X'X and X'A, one aggregate per iteration; the
    lineage is cut with ``checkpoint()`` every 5 iterations.
    Returns (row factors, Y as rows, objective trace).
    """
    import numpy as np
    spark = df.sparkSession
    z = zscale(df.select(id_col, *cols), cols)
    A = [f"{c}_z" for c in cols]
    p = len(cols)
    pcs = pca(z.select(id_col, *A), A, k)
    Y = np.array(PCA(k=k, inputCol="features", outputCol="_pcs").fit(assemble(z, A)).pc.toArray()).T  # k x p
    cur = pcs.select(id_col, *A, *[F.col("pc")[j].alias(f"x{j}") for j in range(k)]).persist()  # every step reads them, not what they come from
    soft = lambda v, t: F.when(v > t, v - t).when(v < -t, v + t).otherwise(F.lit(0.0))
    trace = []
    for it in range(iters):
        Lx = max(2 * float(np.linalg.norm(Y @ Y.T, 2)), 1e-12)
        resid = [sum((F.col(f"x{j}") * float(Y[j, q]) for j in range(k)), F.lit(0.0)) - F.col(A[q]) for q in range(p)]
        grads = [sum((resid[q] * float(Y[j, q]) for q in range(p)), F.lit(0.0)) * 2.0 for j in range(k)]
        cur = cur.select(id_col, *A, *[soft(F.col(f"x{j}") - grads[j] / Lx, gamma_x / Lx).alias(f"x{j}") for j in range(k)])
        if it % 5 == 4:
            cur = cur.checkpoint()
        sums = cur.agg(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"xx{i}_{j}") for i in range(k) for j in range(k)],
                       *[F.sum(F.col(f"x{i}") * F.col(A[q])).alias(f"xa{i}_{q}") for i in range(k) for q in range(p)],
                       *[F.sum(F.col(a) * F.col(a)).alias(f"aa{q}") for q, a in enumerate(A)],
                       *[F.sum(F.abs(F.col(f"x{j}"))).alias(f"l1x{j}") for j in range(k)]).first()
        XX = np.array([[sums[f"xx{i}_{j}"] for j in range(k)] for i in range(k)])
        XA = np.array([[sums[f"xa{i}_{q}"] for q in range(p)] for i in range(k)])
        Ly = max(2 * float(np.linalg.norm(XX, 2)), 1e-12)
        G = 2 * (XX @ Y - XA)
        Yn = Y - G / Ly
        Y = np.sign(Yn) * np.maximum(np.abs(Yn) - gamma_y / Ly, 0.0)
        aa = sum(sums[f"aa{q}"] for q in range(p))
        loss = aa - 2 * float(np.sum(XA * Y)) + float(np.sum((Y.T @ XX) * Y.T))
        trace.append((it, loss + gamma_x * sum(sums[f"l1x{j}"] for j in range(k)) + gamma_y * float(np.abs(Y).sum())))
    ydf = spark.createDataFrame([(f"archetype{j}", *[float(v) for v in Y[j]]) for j in range(k)], ["archetype", *cols])
    tdf = spark.createDataFrame(trace, "iteration int, objective double")
    return cur.select(id_col, *[f"x{j}" for j in range(k)]), ydf, tdf


def suppress_loadings(loadings: DataFrame, cut: float = 0.42, prefix: str = "factor") -> DataFrame:
    """Keep only loadings above the cut (positive side), blank otherwise."""
    cols = [c for c in loadings.columns if c.startswith(prefix)]
    return loadings.select(*[c for c in loadings.columns if c not in cols],
                           *[F.when(F.col(c) > cut, F.col(c)).alias(c) for c in cols])
