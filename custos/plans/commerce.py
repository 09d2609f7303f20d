"""Registered queries: sales marts and customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custos.operators import clv, marts
from custos.plans import sqlhelp
from custos.plans.registry import register
from custos.sources.fixtures import fixture, with_views

# Parameters of the registered queries.  The reference filters on its own
# calendar (2016+, cutoff 2020-12); the test tables span 1995-2001, so the
# same filters are placed inside that span to keep them selective.
SINCE = "1996-01-01"
PROFILE_CUTOFF = "2001-01-01"
# Fixed model parameters for the SQL-checkable prediction columns.
BG_FIXED = clv.BGParams(r=0.25, alpha=4.0, a=0.8, b=2.5)
GG_FIXED = clv.GGParams(p=6.0, q=4.0, v=15.0)


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_customer(fixture(spark, sf, "transactions"), since=SINCE)


_MONTHLY_SQL = f"""monthly AS (
  SELECT customer_id, email, date, count(product_amount) AS orders,
         cast(sum(product_amount) AS double) / count(product_amount) AS amount
  FROM (SELECT customer_id, lower(email) AS email, cast(date_trunc('month', order_date) AS date) AS date,
               product_amount FROM transactions WHERE product_amount >= 0) t
  WHERE date >= DATE '{SINCE}' GROUP BY customer_id, email, date)"""


def _with_monthly(body: str) -> str:
    return with_views(f"WITH {_MONTHLY_SQL}\n{body}", "transactions")


register("monthly_customer", _with_monthly("SELECT * FROM monthly"))(monthly)


def _weekly_sql(keys: list[str], join: str, views: tuple[str, ...]) -> str:
    pu, ps = sqlhelp.spark_avg_units(sqlhelp.units("product_price", 2), 18, 2)
    du, ds = sqlhelp.spark_avg_units(sqlhelp.units("product_discount_amount", 4), 23, 4)
    opu, ops = sqlhelp.spark_avg_units("pu", 22, ps)
    odu, ods = sqlhelp.spark_avg_units("du", 27, ds)
    inner_keys = "".join(f", {k}" for k in keys)
    outer_keys = "".join(f", {k.split('.')[-1]}" for k in keys if k.endswith("product_type"))
    disc, price = sqlhelp.units_to_double(odu, ods), sqlhelp.units_to_double(opu, ops)
    return with_views(f"""
SELECT cast(date_trunc('week', order_date) AS date) AS week_date{outer_keys}, sum(total_gross_margin) AS total_gross_margin,
  {disc} AS avg_disc, {price} AS a_price, {disc} / {price} AS pdisc,
  cast(sum(total_units) AS bigint) AS total_units, cast(sum(num_orders) AS bigint) AS total_orders
FROM (SELECT order_date, order_id{inner_keys}, sum(gross_margin) AS total_gross_margin,
             {pu} AS pu, {du} AS du, sum(num_units) AS total_units, count(DISTINCT order_id) AS num_orders
      FROM order_line_revenue olr {join}
      WHERE valid_order_flag = 1 GROUP BY order_date, order_id{inner_keys}) f
GROUP BY ALL""", *views)


@register("weekly_sales", _weekly_sql([], "", ("order_line_revenue",)))
def weekly_sales(spark, sf):
    return marts.weekly_sales(fixture(spark, sf, "order_line_revenue"))


@register("weekly_sales_by_product", _weekly_sql(["olr.sku", "sa.product_type"],
                                                 "LEFT JOIN sku_attributes sa ON sa.sku = olr.sku",
                                                 ("order_line_revenue", "sku_attributes")))
def weekly_sales_by_product(spark, sf):
    return marts.weekly_sales_by_product(fixture(spark, sf, "order_line_revenue"),
                                         fixture(spark, sf, "sku_attributes"))


def _profile_sql(op: str) -> str:
    return with_views(f"""
, first_order AS (SELECT cp.unique_customer_id, cp.first_order_id, cp.last_order_id,
    cast(month(olr.order_date) AS integer) AS fo_date, first_order_fc_channel AS fo_channel, first_order_fc_vendor AS fo_vendor,
    sum(olr.gross_margin) AS fo_gross_margin, sum(olr.num_units) AS fo_num_units, sum(olr.discount_amount) AS fo_discount_amt,
    sum(olr.shipping_amount) AS fo_shipping_amt, sum(olr.refund_amount) AS fo_refund_amt
  FROM customer_profiles cp LEFT JOIN order_line_revenue olr ON olr.order_id = cp.first_order_id
  GROUP BY cp.unique_customer_id, cp.first_order_id, cp.last_order_id, olr.order_date, first_order_fc_channel, first_order_fc_vendor)
SELECT cp.unique_customer_id, fo_channel, fo_vendor, fo_date, sum(fo_gross_margin) AS fo_gross_margin,
  cast(sum(fo_num_units) AS bigint) AS fo_num_units, sum(fo_discount_amt) AS fo_discount_amt,
  sum(fo_shipping_amt) AS fo_shipping_amt, sum(fo_refund_amt) AS fo_refund_amt,
  CASE WHEN fo_refund_amt > 0 THEN 1 ELSE 0 END AS refund_flag,
  sum(cp.gross_margin) AS total_gross_margin, cast(sum(cp.num_orders) AS bigint) AS number_orders,
  cp.last_order_date AS lo_date
FROM customer_profiles cp LEFT JOIN first_order fo ON cp.unique_customer_id = fo.unique_customer_id
WHERE cp.last_order_date {op} DATE '{PROFILE_CUTOFF}'
GROUP BY cp.unique_customer_id, cp.last_order_date, fo_channel, fo_vendor, fo_date,
  CASE WHEN fo_refund_amt > 0 THEN 1 ELSE 0 END""", "customer_profiles", "order_line_revenue")


@register("first_order_profile_before", _profile_sql("<"))
def first_order_before(spark, sf):
    return marts.first_order_profile(fixture(spark, sf, "customer_profiles"),
                                     fixture(spark, sf, "order_line_revenue"), PROFILE_CUTOFF, "before")


@register("first_order_profile_after", _profile_sql(">="))
def first_order_after(spark, sf):
    return marts.first_order_profile(fixture(spark, sf, "customer_profiles"),
                                     fixture(spark, sf, "order_line_revenue"), PROFILE_CUTOFF, "after")


# ------------------------------------------------------------------- CLV
def rfm(spark: SparkSession, sf: str, end_offset_days: int = 0, cap: float | None = None) -> DataFrame:
    m = monthly(spark, sf)
    end = m.agg(F.date_sub(F.max("date"), end_offset_days)).scalar()
    return clv.rfm_summary(m, end, freq="M", cap=cap)


_RFM_SQL = """, per AS (
  SELECT customer_id, date AS p, sum(amount) AS v FROM monthly
  WHERE date <= (SELECT cast(date_trunc('month', max(date)) AS date) FROM monthly) GROUP BY customer_id, date),
cust AS (SELECT customer_id, min(p) AS p_min, max(p) AS p_max, count(*) AS n,
  list_reduce(list_prepend(0.0, list(v ORDER BY p)[2:]), lambda acc, x: acc + x) AS v_rest
  FROM per GROUP BY customer_id),
rfm AS (SELECT customer_id, n - 1 AS frequency,
  cast(date_diff('day', p_min, p_max) AS double) / 30.436875 AS recency,
  cast(date_diff('day', p_min, (SELECT cast(date_trunc('month', max(date)) AS date) FROM monthly)) AS double) / 30.436875 AS T,
  CASE WHEN n - 1 > 0 THEN v_rest / (n - 1) ELSE 0.0 END AS monetary_value FROM cust)"""


def _p_alive_sql(m: clv.BGParams, x="frequency", tx="recency", t="T") -> str:
    return (f"CASE WHEN {x} = 0 THEN 1.0 ELSE 1.0 / (1.0 + {m.a} / ({m.b} + {x} - 1.0) * "
            f"pow(({m.alpha} + {t}) / ({m.alpha} + {tx}), {m.r} + {x})) END")


@register("rfm_summary", _with_monthly(_RFM_SQL + "\nSELECT * FROM rfm"))
def rfm_query(spark, sf):
    return rfm(spark, sf)


@register("rfm_p_alive", _with_monthly(_RFM_SQL + f"""
SELECT *, round({_p_alive_sql(BG_FIXED)}, 6) AS probability_alive FROM rfm"""))
def rfm_p_alive(spark, sf):
    return clv.with_p_alive(rfm(spark, sf), BG_FIXED)


@register("rfm_expected_profit", _with_monthly(_RFM_SQL + f"""
SELECT customer_id, (({GG_FIXED.p} * frequency) / ({GG_FIXED.p} * frequency + {GG_FIXED.q} - 1.0) * monetary_value
  + (1.0 - ({GG_FIXED.p} * frequency) / ({GG_FIXED.p} * frequency + {GG_FIXED.q} - 1.0)) * {GG_FIXED.p * GG_FIXED.v / (GG_FIXED.q - 1.0)}) AS exp_profit
FROM rfm WHERE frequency > 0 AND monetary_value > 0"""))
def rfm_expected_profit(spark, sf):
    r = rfm(spark, sf).where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
    return r.select("customer_id", clv.expected_profit(F.col("frequency").cast("double"),
                                                        F.col("monetary_value"), GG_FIXED).alias("exp_profit"))


@register("repeat_distribution", _with_monthly(_RFM_SQL + """
SELECT cast(least(frequency, 7) AS bigint) AS frequency, count(*) AS customers FROM rfm GROUP BY 1"""))
def repeat_distribution(spark, sf):
    return clv.repeat_distribution(rfm(spark, sf))


@register("alive_matrix", _with_monthly(_RFM_SQL + f"""
, b AS (SELECT cast(max(frequency) AS integer) AS fmax, cast(floor(max(T)) AS integer) AS tmax FROM rfm),
g AS (SELECT f.frequency, r.recency, b.tmax FROM b, (SELECT unnest(range(0, (SELECT fmax FROM b) + 1)) AS frequency) f,
      (SELECT unnest(range(0, (SELECT tmax FROM b) + 1)) AS recency) r)
SELECT cast(frequency AS bigint) AS frequency, cast(recency AS bigint) AS recency,
  round({_p_alive_sql(BG_FIXED, 'cast(frequency AS double)', 'cast(recency AS double)', 'cast(tmax AS double)')}, 6) AS probability_alive
FROM g"""))
def alive_matrix(spark, sf):
    return clv.alive_matrix(rfm(spark, sf), BG_FIXED)


@register("holdout", _with_monthly("""
, b AS (SELECT max(date) - INTERVAL 365 DAY AS hold_begin, max(date) AS hold_end FROM monthly)
SELECT customer_id, cast(hold_begin AS date) AS hold_begin, hold_end, count(orders) AS trxn, round(sum(amount), 6) AS amount
FROM monthly, b WHERE date > hold_begin AND date < hold_end GROUP BY customer_id, hold_begin, hold_end"""))
def holdout(spark, sf):
    h = clv.holdout(monthly(spark, sf), days=365)
    return h.withColumn("amount", F.round("amount", 6))


@register("calibration_holdout", _with_monthly("""
, e AS (SELECT max(date) AS obs_end, cast(max(date) - INTERVAL 365 DAY AS date) AS cal_end FROM monthly),
cal AS (SELECT customer_id, min(p) AS p_min, max(p) AS p_max, count(*) AS n FROM
  (SELECT DISTINCT customer_id, cast(date_trunc('month', date) AS date) AS p FROM monthly, e WHERE date <= cal_end) GROUP BY customer_id),
hold AS (SELECT customer_id, count(DISTINCT cast(date_trunc('month', date) AS date)) AS fh FROM monthly, e
  WHERE date > cal_end AND date <= obs_end GROUP BY customer_id)
SELECT cal.customer_id, n - 1 AS frequency_cal, cast(date_diff('day', p_min, p_max) AS double) / 30.436875 AS recency_cal,
  cast(date_diff('day', p_min, cast(date_trunc('month', cal_end) AS date)) AS double) / 30.436875 AS T_cal,
  cast(coalesce(fh, 0) AS bigint) AS frequency_holdout,
  cast((year(obs_end) - year(cal_end)) * 12 + month(obs_end) - month(cal_end) AS double) AS duration_holdout
FROM cal CROSS JOIN e LEFT JOIN hold ON cal.customer_id = hold.customer_id"""))
def calibration_holdout(spark, sf):
    m = monthly(spark, sf)
    obs_end = m.agg(F.max("date")).scalar()
    cal_end = m.agg(F.date_sub(F.max("date"), 365)).scalar()
    return clv.calibration_holdout(m, cal_end, obs_end, freq="M")



_WEEKLY = _weekly_sql([], "", ("order_line_revenue",))


@register("weekly_sales_complete", f"""SELECT * FROM ({_WEEKLY}) w
WHERE week_date < (SELECT max(week_date) FROM ({_WEEKLY}) m)""")
def weekly_sales_complete(spark, sf):
    """Drop the last (incomplete) week."""
    w = marts.weekly_sales(fixture(spark, sf, "order_line_revenue"))
    return w.where(F.col("week_date") < w.agg(F.max("week_date")).scalar())
