"""Registered queries: relational statistics and evaluation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from custos.operators import stats
from custos.plans import sqlhelp
from custos.plans.registry import register
from custos.sources.fixtures import fixture, with_views
from custos.sources.tables import scan

LEVEL = 50.0  # A22 level for the sample table (event values are 0-500)


@register("people_distinct", with_views(
    "SELECT DISTINCT first_name, last_name, city, state FROM people", "people"))
def people_distinct(spark, sf):
    return stats.distinct_rows(fixture(spark, sf, "people").select("first_name", "last_name", "city", "state"))


@register("last_order_per_customer", """
SELECT o_custkey, o_orderkey, cast(o_orderdate AS date) AS order_date, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) t
WHERE rn = 1""")
def last_order_per_customer(spark, sf):
    o = scan(spark, sf, "orders")
    return (stats.keep_first(o.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"],
                             ["o_orderdate", "o_orderkey"], descending=True)
                 .select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"),
                         "o_totalprice"))


_q4_units, _q4_scale = sqlhelp.spark_avg_units(sqlhelp.units("q4", 2), 10, 2)


@register("survey_group_means", with_views(f"""
SELECT vert, avg(q8) AS mean_q8, {sqlhelp.units_to_double(_q4_units, _q4_scale)} AS mean_q4
FROM survey GROUP BY vert""", "survey"))
def survey_group_means(spark, sf):
    g = stats.group_means(fixture(spark, sf, "survey"), ["vert"], ["q8", "q4"])
    return g.select("vert", "mean_q8", F.col("mean_q4").cast("double").alias("mean_q4"))


@register("survey_group_median", with_views("""
SELECT ds_role, round(median(cast(q5 AS double)), 6) AS median_q5 FROM survey GROUP BY ds_role""", "survey"))
def survey_group_median(spark, sf):
    g = stats.group_median(fixture(spark, sf, "survey"), ["ds_role"], "q5")
    return g.select("ds_role", F.round("median_q5", 6).alias("median_q5"))


@register("dept_share", with_views("""
SELECT dept, count(*) AS n, count(*) / (SELECT count(*) FROM survey) AS share FROM survey GROUP BY dept""", "survey"))
def dept_share(spark, sf):
    return stats.share_of_total(fixture(spark, sf, "survey"), ["dept"])


@register("vert_dept_mode", with_views("""
SELECT vert, dept AS mode_dept, n AS mode_count FROM (
  SELECT vert, dept, n, row_number() OVER (PARTITION BY vert ORDER BY n DESC, dept) AS rn FROM (
    SELECT vert, dept, count(*) AS n FROM survey WHERE dept IS NOT NULL GROUP BY vert, dept) c) r WHERE rn = 1""", "survey"))
def vert_dept_mode(spark, sf):
    return stats.group_mode(fixture(spark, sf, "survey"), ["vert"], "dept")


@register("dept_value_counts", with_views("SELECT dept, count(*) AS count FROM survey GROUP BY dept", "survey"))
def dept_value_counts(spark, sf):
    return stats.value_counts(fixture(spark, sf, "survey"), "dept")


@register("role_status_crosstab", with_views("""
SELECT ds_role, orig_clust, count(*) AS count FROM survey GROUP BY ds_role, orig_clust""", "survey"))
def role_status_crosstab(spark, sf):
    return stats.crosstab_long(fixture(spark, sf, "survey"), "ds_role", "orig_clust")


def _describe_sql(cols):
    parts = []
    for c in cols:
        x = f"cast({c} AS double)"
        parts.append(f"""SELECT '{c}' AS column_name, s.stat, s.value FROM (SELECT
  count({x}) AS c, round(avg({x}), 6) AS m, round(stddev_samp({x}), 6) AS sd, min({x}) AS mi,
  round(quantile_cont({x}, 0.25), 6) AS q1, round(quantile_cont({x}, 0.5), 6) AS q2,
  round(quantile_cont({x}, 0.75), 6) AS q3, max({x}) AS ma FROM survey) a,
  LATERAL (VALUES ('count', cast(a.c AS double)), ('mean', a.m), ('std', a.sd), ('min', a.mi), ('25%', a.q1),
                  ('50%', a.q2), ('75%', a.q3), ('max', a.ma)) s(stat, value)""")
    return with_views("\nUNION ALL\n".join(parts), "survey")


@register("survey_describe", _describe_sql(["q4", "q8"]))
def survey_describe(spark, sf):
    return stats.describe(fixture(spark, sf, "survey"), ["q4", "q8"])


def _describe_ext_sql(cols):
    parts = []
    for c in cols:
        x = f"cast({c} AS double)"
        parts.append(f"""SELECT '{c}' AS column_name, cast(n AS double) AS n, round(mean, 6) AS mean, round(sd, 6) AS sd,
  round(median, 6) AS median, round(tsum / tn, 6) AS trimmed, round(mad0 * 1.4826, 6) AS mad, mi AS min, ma AS max,
  ma - mi AS range, round(m3 / pow(m2, 1.5) * pow((n - 1) / n, 1.5), 6) AS skew,
  round(m4 / pow(m2, 2) * pow((n - 1) / n, 2) - 3, 6) AS kurtosis, round(sd / sqrt(n), 6) AS se
FROM (SELECT count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, median(x) AS median, min(x) AS mi, max(x) AS ma
      FROM (SELECT {x} AS x FROM survey WHERE {c} IS NOT NULL)) b,
     (SELECT avg(pow(x - m, 2)) AS m2, avg(pow(x - m, 3)) AS m3, avg(pow(x - m, 4)) AS m4, median(abs(x - md)) AS mad0
      FROM (SELECT {x} AS x FROM survey WHERE {c} IS NOT NULL),
           (SELECT avg({x}) AS m, median({x}) AS md FROM survey WHERE {c} IS NOT NULL)) mo,
     (SELECT sum(x * keep) AS tsum, sum(keep) AS tn FROM (
        SELECT x, greatest(0, least(cum, nn - k) - greatest(cum - c, k)) AS keep FROM (
          SELECT x, c, sum(c) OVER (ORDER BY x) AS cum, nn, floor(nn * 0.1) AS k FROM
            (SELECT x, count(*) AS c FROM (SELECT {x} AS x FROM survey WHERE {c} IS NOT NULL) GROUP BY x),
            (SELECT count(*) AS nn FROM survey WHERE {c} IS NOT NULL)))) t""")
    return with_views("\nUNION ALL\n".join(parts), "survey")


@register("survey_describe_extended", _describe_ext_sql(["q4", "q8"]))
def survey_describe_extended(spark, sf):
    return stats.describe_extended(fixture(spark, sf, "survey"), ["q4", "q8"])


@register("transactions_scalar_stats", with_views("""
SELECT count(*) AS rows, max(cast(product_amount AS double)) AS max,
  round(avg(cast(product_amount AS double)), 4) AS mean, round(stddev_samp(cast(product_amount AS double)), 4) AS std
FROM transactions""", "transactions"))
def transactions_scalar_stats(spark, sf):
    s = stats.scalar_stats(fixture(spark, sf, "transactions"), "product_amount")
    return s.select("rows", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


_CORR_COLS = ["q4", "q5", "q6", "q7"]


@register("survey_corr_long", with_views("\nUNION ALL\n".join(
    f"SELECT '{a}' AS left_col, '{b}' AS right_col, round(corr(cast({a} AS double), cast({b} AS double)), 6) AS corr FROM survey"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]), "survey"))
def survey_corr_long(spark, sf):
    return stats.corr_long(fixture(spark, sf, "survey"), _CORR_COLS)


@register("q5_histogram", with_views("""
SELECT coalesce(bin, 0) AS bin, lo + coalesce(bin, 0) * (hi - lo) / 10 AS bin_start, count(*) AS count FROM (
  SELECT least(floor((x - lo) / ((hi - lo) / 10)), 9) AS bin, lo, hi FROM
    (SELECT cast(q5 AS double) AS x FROM survey WHERE q5 IS NOT NULL),
    (SELECT min(cast(q5 AS double)) AS lo, max(cast(q5 AS double)) AS hi FROM survey)) t
GROUP BY bin, lo, hi""", "survey"))
def q5_histogram(spark, sf):
    h = stats.histogram(fixture(spark, sf, "survey"), "q5", 10)
    return h.withColumn("bin", F.col("bin").cast("double"))


@register("sample_quantiles", with_views("""
SELECT step, round(quantile_cont(cast(value AS double), 0.025), 6) AS lower,
  round(quantile_cont(cast(value AS double), 0.5), 6) AS median,
  round(quantile_cont(cast(value AS double), 0.975), 6) AS upper FROM samples GROUP BY step""", "samples"))
def sample_quantiles(spark, sf):
    return stats.quantiles_by_step(fixture(spark, sf, "samples"))


@register("sample_prob_vs_level", with_views(f"""
SELECT step, CASE WHEN med1 > {LEVEL} THEN 'up' ELSE 'down' END AS direction,
  CASE WHEN med1 > {LEVEL} THEN p_up ELSE p_down END AS probability FROM (
  SELECT step, avg(CASE WHEN cast(value AS double) > {LEVEL} THEN 1.0 ELSE 0.0 END) AS p_up,
    avg(CASE WHEN cast(value AS double) < {LEVEL} THEN 1.0 ELSE 0.0 END) AS p_down FROM samples GROUP BY step) g,
  (SELECT median(cast(value AS double)) AS med1 FROM samples WHERE step = (SELECT min(step) FROM samples)) f""", "samples"))
def sample_prob_vs_level(spark, sf):
    return stats.prob_vs_level(fixture(spark, sf, "samples"), LEVEL)


@register("survey_regression_line", with_views("""
SELECT round(regr_slope(cast(q5 AS double), cast(q4 AS double)), 6) AS slope,
  round(regr_intercept(cast(q5 AS double), cast(q4 AS double)), 6) AS intercept,
  round(regr_r2(cast(q5 AS double), cast(q4 AS double)), 6) AS r2,
  regr_count(cast(q5 AS double), cast(q4 AS double)) AS n FROM survey""", "survey"))
def survey_regression_line(spark, sf):
    return stats.regression_line(fixture(spark, sf, "survey"), "q5", "q4")


# ------------------------------------------------------------ evaluation
@register("credit_confusion", with_views("""
SELECT credit_appl AS actual, pred AS predicted, count(*) AS count FROM credit GROUP BY 1, 2""", "credit"))
def credit_confusion(spark, sf):
    return stats.confusion(fixture(spark, sf, "credit"), "credit_appl", "pred")


@register("credit_class_report", with_views("""
, cm AS (SELECT credit_appl AS a, pred AS p, count(*) AS c FROM credit GROUP BY 1, 2),
per AS (SELECT cast(cls AS varchar) AS label, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(npred, 0) AS npred FROM
  (SELECT a AS cls, sum(c) AS support FROM cm GROUP BY a) s
  FULL JOIN (SELECT p AS cls, sum(c) AS npred FROM cm GROUP BY p) q USING (cls)
  LEFT JOIN (SELECT a AS cls, c AS tp FROM cm WHERE a = p) t USING (cls)),
m AS (SELECT label, tp, support, coalesce(cast(tp AS double) / nullif(cast(npred AS double), 0), 0.0) AS precision,
  coalesce(cast(tp AS double) / nullif(cast(support AS double), 0), 0.0) AS recall FROM per),
f AS (SELECT *, coalesce((2.0 * precision * recall) / nullif(precision + recall, 0), 0.0) AS f1 FROM m),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
  sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM f)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, cast(support AS bigint) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(cast(tp AS double) / cast(n AS double), 6), cast(n AS bigint) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), cast(n AS bigint) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), cast(n AS bigint) FROM tot""", "credit"))
def credit_class_report(spark, sf):
    return stats.class_report(fixture(spark, sf, "credit"), "credit_appl", "pred")


@register("credit_accuracy", with_views("""
SELECT avg(CASE WHEN credit_appl = pred THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM credit""", "credit"))
def credit_accuracy(spark, sf):
    return stats.accuracy(fixture(spark, sf, "credit"), "credit_appl", "pred")


@register("credit_roc_points", with_views("""
SELECT threshold, tp, fp, tp / P AS tpr, fp / N AS fpr FROM (
  SELECT threshold, sum(tp_at) OVER (ORDER BY threshold DESC) AS tp, sum(fp_at) OVER (ORDER BY threshold DESC) AS fp
  FROM (SELECT cast(score AS double) AS threshold, sum(cast(credit_appl AS bigint)) AS tp_at,
               sum(cast(1 - credit_appl AS bigint)) AS fp_at FROM credit GROUP BY 1)) c,
  (SELECT sum(credit_appl) AS P, sum(1 - credit_appl) AS N FROM credit) t""", "credit"))
def credit_roc_points(spark, sf):
    r = stats.roc_points(fixture(spark, sf, "credit"), "credit_appl", "score")
    return r.select("threshold", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                    "tpr", "fpr")


@register("credit_auc", with_views("""
SELECT cast(sum(pos * (coalesce(cneg, 0) * 2 + neg)) AS double) / (2.0 * sum(pos) * sum(neg)) AS auc,
  sum(pos) AS positives, sum(neg) AS negatives FROM (
  SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cneg FROM (
    SELECT cast(score AS double) AS s, sum(cast(credit_appl AS bigint)) AS pos, sum(cast(1 - credit_appl AS bigint)) AS neg
    FROM credit GROUP BY 1))""", "credit"))
def credit_auc(spark, sf):
    a = stats.auc(fixture(spark, sf, "credit"), "credit_appl", "score")
    return a.select("auc", F.col("positives").cast("bigint").alias("positives"),
                    F.col("negatives").cast("bigint").alias("negatives"))


@register("survey_anova", with_views("""
SELECT round(ssb, 4) AS ss_between, round(ssw, 4) AS ss_within, k - 1 AS df_between, n - k AS df_within,
  round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f FROM (
  SELECT sum(n * pow(m - gm, 2)) AS ssb, sum(n * v) AS ssw, count(*) AS k, sum(n) AS n FROM (
    SELECT ds_role, count(cast(q4 AS double)) AS n, avg(cast(q4 AS double)) AS m, var_pop(cast(q4 AS double)) AS v
    FROM survey GROUP BY ds_role), (SELECT avg(cast(q4 AS double)) AS gm FROM survey))""", "survey"))
def survey_anova(spark, sf):
    a = stats.anova_oneway(fixture(spark, sf, "survey"), "q4", "ds_role")
    return a.select("ss_between", "ss_within", F.col("df_between").cast("bigint").alias("df_between"),
                    F.col("df_within").cast("bigint").alias("df_within"), "f")


@register("survey_chisq", with_views("""
SELECT round(sum(o * o / (ra * cb / n)) - max(n), 6) AS chi2, (count(DISTINCT ds_role) - 1) * (count(DISTINCT orig_clust) - 1) AS df
FROM (SELECT ds_role, orig_clust, count(*) AS o FROM survey GROUP BY 1, 2) obs
JOIN (SELECT ds_role, count(*) AS ra FROM survey GROUP BY 1) USING (ds_role)
JOIN (SELECT orig_clust, count(*) AS cb FROM survey GROUP BY 1) USING (orig_clust),
(SELECT count(*) AS n FROM survey)""", "survey"))
def survey_chisq(spark, sf):
    c = stats.chisq(fixture(spark, sf, "survey"), "ds_role", "orig_clust")
    return c.select("chi2", F.col("df").cast("bigint").alias("df"))


@register("survey_cluster_profile", with_views("""
SELECT m.orig_clust, mean_q8, size, mode_dept FROM
  (SELECT orig_clust, avg(q8) AS mean_q8, count(*) AS size FROM survey GROUP BY orig_clust) m
LEFT JOIN (SELECT orig_clust, dept AS mode_dept FROM (
  SELECT orig_clust, dept, row_number() OVER (PARTITION BY orig_clust ORDER BY n DESC, dept) AS rn FROM (
    SELECT orig_clust, dept, count(*) AS n FROM survey WHERE dept IS NOT NULL GROUP BY 1, 2))
  WHERE rn = 1) d ON m.orig_clust = d.orig_clust""", "survey"))
def survey_cluster_profile(spark, sf):
    return stats.cluster_profile(fixture(spark, sf, "survey"), "orig_clust", ["q8"], ["dept"])
