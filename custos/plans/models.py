"""Registered queries without an SQL oracle: model fits and forecasts.

Property tests of the operators behind them are in ``tests/test_properties.py``
and ``tests/test_regressions.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from custos.operators import clv, forecast, ml, stats
from custos.plans import commerce, series
from custos.plans.registry import register
from custos.sources.fixtures import fixture

CAP = 300_000.0   # monetary cap in test-table currency (reference: 600 / 500 in its own units)
PENALIZER = 0.01
WHOLESALE = 5_000_000.0  # wholesaler CLV threshold in test-table currency (reference: 1000)


def _fitted(spark, sf):
    """RFM table below the monetary cap and fitted parameters."""
    r = commerce.rfm(spark, sf, cap=CAP)
    return r, clv.fit_bgnbd(r, PENALIZER), clv.fit_gamma_gamma(r, PENALIZER)


@register("clv_model_params")
def clv_model_params(spark, sf):
    """Fitted BG/NBD and Gamma-Gamma parameters (one row)."""
    _, bg, gg = _fitted(spark, sf)
    return spark.createDataFrame([(bg.r, bg.alpha, bg.a, bg.b, gg.p, gg.q, gg.v)],
                                 "r double, alpha double, a double, b double, p double, q double, v double")


def predictions(spark, sf):
    r, bg, gg = _fitted(spark, sf)
    pred = (r.withColumn("predicted_num_trxn", clv.expected_purchases(F.col("frequency"), F.col("recency"), F.col("T"), 12, bg))
             .withColumn("probability_alive", clv.p_alive(F.col("frequency"), F.col("recency"), F.col("T"), bg)))
    return clv.clv(pred, bg, gg, months=12, discount=0.01, freq="M")


@register("clv_predictions")
def clv_predictions(spark, sf):
    """Expected purchases, P(alive), CLV, expected profit, margin CLV."""
    return predictions(spark, sf).withColumn("clv_margin", F.col("predicted_cltv") * 0.05)


@register("ltv_validation")
def ltv_validation(spark, sf):
    """Calibration (to max - 365 days) vs holdout purchases by frequency."""
    m = commerce.monthly(spark, sf)
    obs_end = m.agg(F.max("date")).scalar()
    cal_end = m.agg(F.date_sub(F.max("date"), 365)).scalar()
    ch = clv.calibration_holdout(m, cal_end, obs_end, freq="M")
    bg = clv.fit_bgnbd(commerce.rfm(spark, sf, end_offset_days=365, cap=CAP), PENALIZER)
    return clv.ltv_valid(ch, bg, 12)


@register("rfm_segment_profile")
def rfm_segment_profile(spark, sf):
    """K-means segments of z-scaled RFM, ranked by recency, labelled."""
    _, prof = ml.rfm_segments(commerce.rfm(spark, sf), CAP, 3)
    return clv.segment_labels(prof)


@register("customer_scores")
def customer_scores(spark, sf):
    """Scoring table with flags, rounded transactions and anonymised email."""
    lab, _ = ml.rfm_segments(commerce.rfm(spark, sf), CAP, 3)
    return clv.score_customers(predictions(spark, sf), commerce.monthly(spark, sf), lab.select("customer_id", "cluster"),
                               wholesale_at=WHOLESALE)


@register("clv_summary_by_trx")
def clv_summary_by_trx(spark, sf):
    """C14: mean CLV and share per predicted transactions (wholesalers excluded)."""
    return clv.summary_by_trx(clv.score_customers(predictions(spark, sf), commerce.monthly(spark, sf),
                                                  wholesale_at=WHOLESALE))


@register("holdout_vs_prediction")
def holdout_vs_prediction(spark, sf):
    """Predicted CLV against holdout spend: correlation, line, medians by transactions."""
    hold = clv.holdout(commerce.monthly(spark, sf), 365)
    _, red = clv.merge_holdout(predictions(spark, sf), hold, 1_000_000.0)
    line = stats.regression_line(red, "amount", "predicted_cltv")
    corr = red.agg(F.corr("predicted_cltv", "amount").alias("corr"))
    med = (red.where(F.col("trxn") < 10).groupBy("trxn")
              .agg(F.median("predicted_cltv").alias("median_cltv"), F.median("amount").alias("median_amount")))
    # one-row aggregates attached as scalar subqueries
    return med.select("*", *[line.select(c).scalar().alias(c) for c in line.columns],
                      corr.select("corr").scalar().alias("corr"))


@register("credit_logit_table")
def credit_logit_table(spark, sf):
    """Binomial GLM inference table on the credit fixture."""
    return ml.glm_table(fixture(spark, sf, "credit"), ["account_balance", "purpose", "score"], "credit_appl")


@register("credit_forest_importance")
def credit_forest_importance(spark, sf):
    """Class-balanced random forest, importance table."""
    tr, _ = ml.hash_split(fixture(spark, sf, "credit"), "id", 0.7)
    _, imp = ml.forest(tr, ["account_balance", "purpose", "score"], "credit_appl", trees=50, balanced=True)
    return imp


@register("survey_kmeans_elbow")
def survey_kmeans_elbow(spark, sf):
    """M6: within-cluster sum of squares for k = 1..6 on z-scaled survey measures."""
    z = ml.zscale(fixture(spark, sf, "survey"), ["q4", "q6", "q7", "q8"])
    return ml.elbow(z, ["q4_z", "q6_z", "q7_z", "q8_z"], 6)


@register("survey_segments")
def survey_segments(spark, sf):
    """M34 (M13 + M5 + M9): PCA -> k-means -> profile with silhouette."""
    s = fixture(spark, sf, "survey").select("resp_id", *[F.col(c).cast("double").alias(c) for c in ("q4", "q6", "q7", "q8")])
    _, prof, sil = ml.segment(s, ["q4", "q6", "q7", "q8"], 3)
    return prof.withColumn("silhouette", F.lit(sil))


@register("monthly_ar_fit")
def monthly_ar_fit(spark, sf):
    """AR(2) with two regressors on the monthly series (moment sums)."""
    m = series.monthly_series(spark, sf)
    return forecast.ar_fit(m, [], "dt", "sales", ["intent", "spend"], p=2, d=1)


@register("event_ar_forecast")
def event_ar_forecast(spark, sf):
    """Per-series AR(1) fit and 7-step forecast with 95% bounds."""
    e = fixture(spark, sf, "event_daily")
    fit = forecast.ar_fit(e, ["series_id"], "dt", "value", [], p=1)
    return forecast.ar_forecast(e, fit, ["series_id"], "dt", "value", 1, 7)


@register("event_dlm_forecast")
def event_dlm_forecast(spark, sf):
    """Per-series dynamic linear model, one-step and 3 future steps."""
    e = fixture(spark, sf, "event_daily")
    return forecast.dlm(e, ["series_id"], "dt", "value", [], periods=(7,), harmonics=((1,),), prior_len=10, h=3)
