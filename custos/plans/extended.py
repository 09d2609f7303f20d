"""Registered queries: preparation (F7, M1-M4, P18, P26), files (S4/S5, S11, S12),
stationarity (W14/W15), more models (M7-M24) and forecasts (T1, T3-T7, T10), Q1."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from custos.operators import forecast, ml, populations, timeseries as ts, ward
from custos.plans import commerce, series
from custos.plans.documents import _CHUNKS
from custos.plans import entity  # noqa: F401  (its oracle is used below)
from custos.plans.registry import ORACLE, register
from custos.session import ensure_checkpoint_dir
from custos.sources import files
from custos.sources.fixtures import fixture, with_views
from custos.sources.tables import scan

POOL_BELOW = 1250  # P26: sizes seen fewer times than this are pooled (test-table scale)


def _scratch(spark, tag):
    """A fresh folder under the cluster's checkpoint dir for one call (never machine-local on a cluster)."""
    import uuid
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------ preparation
@register("survey_scaling", with_views("""
SELECT resp_id, dept, round((cast(q8 AS double) - (SELECT avg(cast(q8 AS double)) FROM survey))
  / (SELECT stddev_pop(cast(q8 AS double)) FROM survey), 6) AS q8_z,
  cast(q5 - (SELECT min(q5) FROM survey) AS double) / cast((SELECT max(q5) FROM survey) - (SELECT min(q5) FROM survey) AS double) AS q5_mm
FROM survey""", "survey"))
def survey_scaling(spark, sf):
    s = fixture(spark, sf, "survey")
    z = ml.minmax(ml.zscale(s, ["q8"]), ["q5"])
    return z.select("resp_id", "dept", F.round("q8_z", 6).alias("q8_z"), "q5_mm")


@register("credit_one_hot", with_views("SELECT id, purpose, " + ", ".join(
    f"CASE WHEN purpose = {i} THEN 1 ELSE 0 END AS Category_{i}" for i in range(1, 6)) + " FROM credit", "credit"))
def credit_one_hot(spark, sf):
    return ml.one_hot(fixture(spark, sf, "credit").select("id", "purpose"), "purpose")


@register("daily_chrono_split", series._dsql("""
SELECT dt, river, CASE WHEN row_number() OVER (ORDER BY dt) - 1 < floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part
FROM d"""))
def daily_chrono_split(spark, sf):
    d = series.daily(spark, sf).select("dt", "river")
    tr, te = ml.chrono_split(d, "dt", 0.8)
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


@register("survey_pooled_sizes", with_views(f"""
SELECT CASE WHEN n < {POOL_BELOW} THEN 'other' ELSE cast(q8 AS varchar) END AS size_level, sum(n) AS n FROM (
  SELECT q8, count(*) AS n FROM survey GROUP BY q8) GROUP BY 1""", "survey"))
def survey_pooled_sizes(spark, sf):
    s = fixture(spark, sf, "survey")
    c = s.groupBy("q8").agg(F.count("*").alias("n"))
    lvl = F.when(F.col("n") < POOL_BELOW, F.lit("other")).otherwise(F.col("q8").cast("string"))
    return c.groupBy(lvl.alias("size_level")).agg(F.sum("n").alias("n"))


@register("weekly_discount_scenarios", f"""WITH w AS ({commerce._weekly_sql([], "", ("order_line_revenue",))}),
lv AS (SELECT [arg_max(pdisc, week_date), 0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30]::DOUBLE[] AS v FROM w)
SELECT cast(s AS integer) AS scenario, v[s + 1] AS value, cast(h AS integer) AS step
FROM lv, (SELECT unnest(range(0, 8)) AS s), (SELECT unnest(range(1, 13)) AS h)""")
def weekly_discount_scenarios(spark, sf):
    """Last weekly discount rate and 0-30% levels over a 12-week horizon."""
    w = commerce.weekly_sales(spark, sf)
    last = w.agg(F.max_by("pdisc", "week_date")).scalar()
    return ts.scenario_grid(last, spark=spark)


@register("credit_splits")
def credit_splits(spark, sf):
    """M2/M3: hash split 70/30 and stratified 70/30 sizes per class."""
    c = fixture(spark, sf, "credit")
    tr, te = ml.hash_split(c, "id", 0.7)
    st, sv = ml.stratified_split(c, "id", "credit_appl", 0.7)
    parts = [(tr, "hash_train"), (te, "hash_test"), (st, "strat_train"), (sv, "strat_test")]
    out = None
    for df, name in parts:
        g = df.groupBy("credit_appl").agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
        out = g if out is None else out.unionByName(g)
    return out


# ------------------------------------------------------------------- files
@register("orders_csv_roundtrip", """
SELECT o_orderkey, cast(o_orderdate AS date) AS order_date, cast(o_totalprice AS decimal(18,2)) AS amount FROM orders""")
def orders_csv_roundtrip(spark, sf):
    """Orders written as CSV with %m/%d/%Y dates, read back with an explicit schema."""
    path = _scratch(spark, "orders-csv")
    o = scan(spark, sf, "orders")
    (o.select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_date"),
              F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
      .write.mode("overwrite").option("header", True).csv(path))
    return files.scan_csv(spark, path, "o_orderkey long, order_date string, amount decimal(18,2)",
                          date_cols={"order_date": "MM/dd/yyyy"})


@register("orders_hash_sample")
def orders_hash_sample(spark, sf):
    """Reproducible 10% sample by key hash, with the fraction it achieved."""
    o = scan(spark, sf, "orders")
    s = files.sample_rows(o, 0.1, seed=42, key="o_orderkey")
    return s.agg(F.count("*").alias("sampled"), (F.count("*") / o.agg(F.count("*")).scalar()).alias("fraction"))


@register("doc_index_roundtrip", "WITH " + _CHUNKS + "\nSELECT * FROM chunks")
def doc_index_roundtrip(spark, sf):
    """Chunk table persisted as the index and reloaded."""
    from custos.operators import docs
    from custos.plans.documents import chunks
    path = _scratch(spark, "doc-index")
    docs.save_index(chunks(spark, sf), path)
    return docs.load_index(spark, path)


# ------------------------------------------------------------ stationarity
@register("monthly_pacf")
def monthly_pacf(spark, sf):
    """Partial autocorrelation to lag 12 of monthly sales."""
    return ts.pacf(series.monthly_series(spark, sf), [], "dt", "sales", 12)


@register("monthly_adf")
def monthly_adf(spark, sf):
    """ADF statistic with AIC lag choice and critical values."""
    return ts.adf(series.monthly_series(spark, sf), [], "dt", "sales")


@register("event_adf")
def event_adf(spark, sf):
    """W15 per series."""
    return ts.adf(fixture(spark, sf, "event_daily"), ["series_id"], "dt", "value", max_lag=3)


# ------------------------------------------------------------------ models
def _survey_num(spark, sf):
    s = fixture(spark, sf, "survey")
    return s.select("resp_id", "dept", "vert", "ds_role", *[F.col(c).cast("double").alias(c) for c in ("q4", "q6", "q7", "q8")])


@register("survey_gmm")
def survey_gmm(spark, sf):
    """M7: Gaussian mixture cluster sizes."""
    lab, _ = ml.gmm(ml.zscale(_survey_num(spark, sf), ["q4", "q8"]), ["q4_z", "q8_z"], 3)
    return lab.groupBy("cluster").agg(F.count("*").alias("size"))


@register("survey_bisecting")
def survey_bisecting(spark, sf):
    """M8 (re-aimed) + M9: divisive clustering sizes and silhouette."""
    cols = ["q4", "q6", "q7", "q8"]
    lab, _ = ml.hierarchical(ml.zscale(_survey_num(spark, sf), cols), [f"{c}_z" for c in cols], 4)
    sil = ml.silhouette(lab)
    return lab.groupBy("cluster").agg(F.count("*").alias("size")).withColumn("silhouette", F.lit(sil).cast("double"))


@register("survey_ward")
def survey_ward(spark, sf):
    """M8: Ward tree (Minkowski distance of order 5) of the z-scaled measures cut at four clusters, with their profiles."""
    cols = ["q4", "q6", "q7", "q8"]
    z = ml.zscale(_survey_num(spark, sf), cols)
    tree = ward.ward_tree(z, [f"{c}_z" for c in cols])
    return (tree.label(z, [f"{c}_z" for c in cols], 4).groupBy("cluster")
                .agg(F.count("*").alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in cols]))


@register("survey_ward_heights")
def survey_ward_heights(spark, sf):
    """M8: the merge heights of that tree, by the number of clusters left (the elbow for choosing k)."""
    cols = ["q4", "q6", "q7", "q8"]
    tree = ward.ward_tree(ml.zscale(_survey_num(spark, sf), cols), [f"{c}_z" for c in cols])
    return spark.createDataFrame(tree.heights(), "clusters int, height double, size long")


@register("survey_kprototypes")
def survey_kprototypes(spark, sf):
    """K-prototypes on two measures and the department."""
    z = ml.zscale(_survey_num(spark, sf), ["q4", "q8"])
    lab, _ = ml.kprototypes(z, ["q4_z", "q8_z"], ["dept"], 3, iters=10)
    return lab.groupBy("cluster").agg(F.count("*").alias("size"), F.avg("q4").alias("mean_q4"))


@register("survey_famd")
def survey_famd(spark, sf):
    """Mixed-data PCA scores summarised per department."""
    f = ml.famd(_survey_num(spark, sf), ["q4", "q8"], ["ds_role"], 2)
    return f.groupBy("dept").agg(F.avg(F.col("pc")[0]).alias("pc1"), F.avg(F.col("pc")[1]).alias("pc2"))


@register("survey_hopkins")
def survey_hopkins(spark, sf):
    """Hopkins statistic on z-scaled measures (exact nearest neighbours, batched)."""
    z = ml.zscale(_survey_num(spark, sf), ["q4", "q6", "q7"]).withColumn("rid", F.monotonically_increasing_id())
    z = z.select("rid", "q4_z", "q6_z", "q7_z").persist()
    h = ml.hopkins(z, ["q4_z", "q6_z", "q7_z"], "rid", fraction=0.05)
    return spark.createDataFrame([(h,)], "hopkins double")


@register("survey_gap")
def survey_gap(spark, sf):
    """Gap statistic for k = 2..4 with 3 reference sets."""
    z = ml.zscale(_survey_num(spark, sf), ["q4", "q8"])
    return ml.gap_statistic(z, ["q4_z", "q8_z"], k_max=4, b=3)


@register("survey_factor_analysis")
def survey_factor_analysis(spark, sf):
    """Loadings (varimax) of four measures on two factors."""
    load, _ = ml.factor_analysis(_survey_num(spark, sf), ["q4", "q6", "q7", "q8"], 2)
    shown = ml.suppress_loadings(load, 0.42)  # P23
    return load.join(shown.select("variable", *[F.col(c).alias(f"{c}_shown") for c in shown.columns if c != "variable"]),
                     "variable")


@register("survey_multinomial")
def survey_multinomial(spark, sf):
    """Multinomial logit of the return flag, reference class 'A'."""
    return ml.multinomial_table(_survey_num(spark, sf), ["q4", "q8"], "ds_role", "A")


@register("credit_model_evaluation")
def credit_model_evaluation(spark, sf):
    """Balanced logistic fit on 70%, scored on 30% (class, probability, AUC, accuracy)."""
    c = fixture(spark, sf, "credit")
    tr, te = ml.hash_split(c, "id", 0.7)
    model, _ = ml.logistic(tr, ["account_balance", "purpose", "score"], "credit_appl", c=1.0, balanced=True)
    pred = model.transform(ml.assemble(te, ["account_balance", "purpose", "score"]))
    auc = ml.binary_auc(pred, "credit_appl")
    return (pred.agg(F.avg((F.col("prediction") == F.col("credit_appl")).cast("double")).alias("accuracy"),
                     F.count("*").alias("scored"))
                .withColumn("auc", F.lit(auc)))


@register("credit_forest_regression_importance")
def credit_forest_regression_importance(spark, sf):
    """Random-forest regression importance for the score."""
    return ml.forest_regression_importance(fixture(spark, sf, "credit"), ["account_balance", "purpose"], "score", trees=30)


@register("credit_cluster_validation")
def credit_cluster_validation(spark, sf):
    """10-fold cross-validated forest predicting a cluster label."""
    c = fixture(spark, sf, "credit").withColumn("segment", (F.col("score") / 10).cast("int").cast("string"))
    _, acc = ml.cluster_validation(c, ["account_balance", "purpose"], "segment", folds=10, trees=10)
    return spark.createDataFrame([(acc,)], "cv_accuracy double")


# ---------------------------------------------------------------- forecasts
@register("monthly_ar_order")
def monthly_ar_order(spark, sf):
    """AIC order search over p = 1..3, d = 0..1."""
    return forecast.ar_order_search(series.monthly_series(spark, sf), [], "dt", "sales", ["spend"], 3, (0, 1))


@register("monthly_ar_residuals")
def monthly_ar_residuals(spark, sf):
    """Fitted values and residuals of AR(2), summarised by the Ljung-Box statistic."""
    m = series.monthly_series(spark, sf)
    fit = forecast.ar_fit(m, [], "dt", "sales", [], p=2)
    res = forecast.fitted_residuals(forecast.ar_design(m, [], "dt", "sales", [], 2), fit, [], 2)
    a = ts.acf(res, [], "dt", "residual", 7)
    return ts.ljung_box(a, res.agg(F.count("*")).scalar(), 7, 2)


@register("monthly_llt_forecast")
def monthly_llt_forecast(spark, sf):
    """Local linear trend (no seasonality), 12 steps ahead."""
    m = series.monthly_series(spark, sf).withColumn("series_id", F.lit("sales"))
    return forecast.dlm(m, ["series_id"], "dt", "sales", [], periods=(), harmonics=(), prior_len=6, h=12)


@register("monthly_chained_forecast")
def monthly_chained_forecast(spark, sf):
    """T5: forecast the regressor (spend) first, then the target with the forecast regressor."""
    m = series.monthly_series(spark, sf).withColumn("series_id", F.lit("m"))
    sp = forecast.dlm(m, ["series_id"], "dt", "spend", [], periods=(12,), harmonics=((1,),), prior_len=12, h=6)
    path = sp.where("step > 0").select("series_id", "step", F.col("forecast").alias("spend"))
    return forecast.dlm(m, ["series_id"], "dt", "sales", ["spend"], periods=(12,), harmonics=((1,),), prior_len=12, future=path)


def _product_weeks(spark, sf):
    w = commerce.weekly_sales_by_product(spark, sf)
    return w.select("product_type", F.col("week_date").alias("dt"), F.col("total_gross_margin").alias("sales"), F.col("pdisc").cast("double").alias("pdisc"))


@register("product_scenario_forecast")
def product_scenario_forecast(spark, sf):
    """T4: weekly sales of every product type along each discount scenario (P18), 12 weeks ahead."""
    w = _product_weeks(spark, sf)
    last = w.groupBy("product_type").agg(F.max_by("pdisc", "dt").alias("last"))
    return forecast.dlm(w, ["product_type"], "dt", "sales", ["pdisc"], periods=(52,), harmonics=((1, 2),), prior_len=26,
                        future=ts.scenario_paths(last, "last", out="pdisc"), scenario="scenario")


@register("product_chained_forecast")
def product_chained_forecast(spark, sf):
    """T5: the discount rate of every product type first, then its sales along the forecast rate, 12 weeks ahead."""
    w = _product_weeks(spark, sf)
    rate = forecast.dlm(w, ["product_type"], "dt", "pdisc", [], periods=(52,), harmonics=((1,),), prior_len=26, h=12)
    path = rate.where("step > 0").select("product_type", "step", F.col("forecast").alias("pdisc"))
    return forecast.dlm(w, ["product_type"], "dt", "sales", ["pdisc"], periods=(52,), harmonics=((1,),), prior_len=26, future=path)


@register("event_count_model")
def event_count_model(spark, sf):
    """T6 (baseline): Poisson GLM of daily event counts on their lag and direction."""
    e = fixture(spark, sf, "event_daily")
    lagged = ts.lags(e, ["series_id"], "dt", ["n"], (1,), diff=False, direction=True).where(F.col("n_lag1").isNotNull())
    lagged = lagged.withColumn("n_lag1", F.col("n_lag1").cast("double")).withColumn("n_up", F.col("n_up").cast("double"))
    return ml.glm_table(lagged.withColumn("n", F.col("n").cast("double")), ["n_lag1", "n_up"], "n", family="poisson")


@register("daily_lookback_regression")
def daily_lookback_regression(spark, sf):
    """Regression on 7-day lookback windows (scaled), MAE / MAPE on the last 20%."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    d = series.daily(spark, sf)
    lb = ts.lookback(d, [], "dt", ["river", "off_river"], "river", 7)
    lb = lb.withColumn("features_raw", array_to_vector(F.flatten("window")))
    tr, te = ml.chrono_split(lb, "dt", 0.8)
    sc = StandardScaler(inputCol="features_raw", outputCol="features").fit(tr)
    model = LinearRegression(featuresCol="features", labelCol="target").fit(sc.transform(tr))
    pred = model.transform(sc.transform(te))
    return pred.agg(F.avg(F.abs(F.col("target") - F.col("prediction"))).alias("mae"),
                    (F.avg(F.when(F.col("target") != 0, F.abs((F.col("target") - F.col("prediction")) / F.col("target")))) * 100).alias("mape"),
                    F.count("*").alias("n"))


# ----------------------------------------------------------------- stream
@register("people_stream_incremental", ORACLE["incremental_merge"])
def people_stream_incremental(spark, sf):
    """Q1: new customer records arrive as files; each batch is matched against known records."""
    from custos.operators import linkage as lk
    from custos.plans.entity import RUN_TS
    from custos.streaming.streams import incremental_match_stream
    base = _scratch(spark, "q1")
    feed = lk.incremental_feed(fixture(spark, sf, "people").withColumn(
        "_loaded_at", F.when(F.col("new_recs") == "1", F.lit("2020-07-01")).otherwise(F.lit("2020-01-01")).cast("timestamp")),
        fixture(spark, sf, "entity_lookup")).drop("timestamp")
    new, old = lk.split_records(feed)
    new.write.mode("overwrite").parquet(os.path.join(base, "new"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in new.schema.fields)
    incremental_match_stream(spark, os.path.join(base, "new"), schema, old, os.path.join(base, "out"),
                             os.path.join(base, "ckpt"), RUN_TS)
    return spark.read.parquet(os.path.join(base, "out")).drop("_batch")


@register("event_online_dlm")
def event_online_dlm(spark, sf):
    """Q3: online model update - two arrival waves of daily event values streamed through per-series state."""
    from custos.streaming.streams import online_dlm_stream, online_results
    base = _scratch(spark, "q3")
    e = fixture(spark, sf, "event_daily").select("series_id", "dt", F.col("value").cast("double").alias("value"))
    mid = e.agg(F.percentile_approx(F.unix_date("dt"), 0.5)).first()[0]
    schema = "series_id string, dt date, value double"
    src = os.path.join(base, "src")
    for wave, cond in enumerate([F.unix_date("dt") <= mid, F.unix_date("dt") > mid]):
        e.where(cond).write.mode("append").parquet(os.path.join(src, f"wave={wave}"))
        # each wave is a new availableNow run; the checkpoint carries the per-series state
        online_dlm_stream(spark, src, schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return online_results(spark, os.path.join(base, "out"))


@register("survey_best_normalize")
def survey_best_normalize(spark, sf):
    """Ranking of normalising transforms for the extended price."""
    return ml.best_normalize(fixture(spark, sf, "survey"), "q5")


@register("survey_glrm")
def survey_glrm(spark, sf):
    """Low-rank archetypes (k = 2) of four standardised measures; objective trace."""
    s = _survey_num(spark, sf).withColumn("rid", F.monotonically_increasing_id())
    _, _, trace = ml.glrm(s, "rid", ["q4", "q6", "q7", "q8"], k=2, iters=10)
    return trace


@register("clv_frequency_recency_matrix")
def clv_frequency_recency_matrix(spark, sf):
    """C17: expected purchases next period over the frequency x recency grid (fitted model)."""
    from custos.operators import clv
    from custos.plans.models import _fitted
    r, bg, _ = _fitted(spark, sf)
    return clv.frequency_recency_matrix(r, bg, 1.0)


@register("dedupe_job")
def dedupe_job(spark, sf):
    """Full run (no result table yet) then an incremental run appending new matches."""
    from custos.operators import linkage as lk
    from custos.plans.entity import RUN_TS
    path = _scratch(spark, "dedupe")
    people = fixture(spark, sf, "people")
    mode1 = lk.run_dedupe(spark, people.where(F.col("new_recs") == "0"), path, RUN_TS)
    feed = lk.incremental_feed(people.withColumn("_loaded_at", F.when(F.col("new_recs") == "1", F.lit("2020-07-01"))
                                                 .otherwise(F.lit("2020-01-01")).cast("timestamp")),
                               fixture(spark, sf, "entity_lookup")).drop("timestamp")
    mode2 = lk.run_dedupe(spark, feed, path, RUN_TS, incremental=True)
    return spark.read.parquet(path).withColumn("runs", F.lit(f"{mode1}+{mode2}"))


@register("doc_tfidf_vectors")
def doc_tfidf_vectors(spark, sf):
    """Hashed TF-IDF vectors of the chunks (stand-in for the remote embedding model)."""
    from custos.operators import docs
    from custos.plans.documents import chunks
    vecs, _ = docs.embed_hashed(chunks(spark, sf), 1 << 16)
    return vecs.select("doc_id", "chunk_id", "features")


@register("documents_text_dir")
def documents_text_dir(spark, sf):
    """Documents written as one text file per document, read back whole (default row when empty)."""
    from custos.operators import docs
    path = _scratch(spark, "docs-dir")
    docs.write_text_dir(scan(spark, sf, "documents"), path)
    back = docs.read_text_dir(spark, path)
    return back.select("doc_id", F.length("text").alias("chars"))


@register("event_count_dlm")
def event_count_dlm(spark, sf):
    """Poisson dynamic model of daily event counts per type."""
    return forecast.count_dlm(fixture(spark, sf, "event_daily"), ["series_id"], "dt", "n", "poisson")


@register("event_binary_dlm")
def event_binary_dlm(spark, sf):
    """Bernoulli dynamic model of 'value went up' per type."""
    e = fixture(spark, sf, "event_daily")
    up = ts.lags(e, ["series_id"], "dt", ["value"], (1,), diff=False, direction=True)
    return forecast.count_dlm(up, ["series_id"], "dt", "value_up", "bernoulli")


@register("customers_complete", """
SELECT c_custkey, c_name, c_acctbal, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey
WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_acctbal IS NOT NULL AND o_orderkey IS NOT NULL""")
def customers_complete(spark, sf):
    """Customers with their orders, only rows without a null."""
    rows = scan(spark, sf, "customer").join(scan(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return populations.complete_rows(rows.select("c_custkey", "c_name", "c_acctbal", "o_orderkey"))


@register("customer_population", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE (c_mktsegment IS NULL OR c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD')) AND (c_nationkey IS NULL OR c_nationkey <> 0)
  AND c_custkey IN (SELECT o_custkey FROM orders)""")
def customer_population(spark, sf):
    """P25: customers outside two segments and one nation that have an order."""
    known = scan(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    rows = scan(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return populations.exclude_population(rows, {"c_mktsegment": ["MACHINERY", "HOUSEHOLD"], "c_nationkey": [0]}, known, "c_custkey")
