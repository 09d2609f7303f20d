"""Sales marts (A1-A4): two-level aggregates over order lines.

All of these are plain DataFrame aggregates: Spark does a partial (map-side)
aggregate per task, shuffles only the group keys + partial buffers, and
finishes per key, so they scale with the number of groups rather than rows.

Money columns stay DECIMAL so totals are exact; a mean is taken as
``double(sum(decimal)) / count`` which gives the same IEEE value in any engine
that sums decimals exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_mean(c: str | Column) -> Column:
    """Mean of a DECIMAL column as a double, independent of summation order."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast("double") / F.count(col).cast("double")


def monthly_customer(tx: DataFrame, since: str = "2016-01-01",
                     lower_email: bool = True) -> DataFrame:
    """A1: orders and mean amount per customer, email and month.

    ``since`` applies to the month (the reference filters on the alias, X7);
    negative amounts are excluded.
    """
    month = F.date_trunc("month", F.col("order_date")).cast("date")
    email = F.lower("email") if lower_email else F.col("email")
    base = (tx.where(F.col("product_amount") >= 0)
              .select("customer_id", email.alias("email"), month.alias("date"),
                      "product_amount")
              .where(F.col("date") >= F.lit(since).cast("date")))
    return (base.groupBy("customer_id", "email", "date")
                .agg(F.count("product_amount").alias("orders"),
                     exact_mean("product_amount").alias("amount")))


ORDER_ROWS = 250_000  # lines that one task groups by order


def _order_day(lines: DataFrame, keys: list[str]) -> DataFrame:
    # hardly two lines share a group, so tasks hold as many groups as lines: these are dealt by their number
    valid = lines.where(F.col("valid_order_flag") == 1)
    need = -(-valid.count() // ORDER_ROWS)
    if need > lines.sparkSession.sparkContext.defaultParallelism:
        valid = valid.repartition(need, "order_date", "order_id")
    return (valid
                 .groupBy("order_date", "order_id", *keys)
                 .agg(F.sum("gross_margin").alias("total_gross_margin"),
                      F.avg("product_price").alias("avg_price"),
                      F.avg("product_discount_amount").alias("prod_discount"),
                      F.sum("num_units").alias("total_units"))
                 # the distinct orders of a group, of which the order is a key: no second level of grouping
                 .withColumn("num_orders", F.col("order_id").isNotNull().cast("bigint")))


def _weekly(inner: DataFrame, keys: list[str]) -> DataFrame:
    week = F.date_trunc("week", F.col("order_date")).cast("date").alias("week_date")
    out = (inner.groupBy(week, *keys)
                .agg(F.sum("total_gross_margin").alias("total_gross_margin"),
                     F.avg("prod_discount").alias("_avg_disc"),
                     F.avg("avg_price").alias("_a_price"),
                     F.sum("total_units").cast("bigint").alias("total_units"),
                     F.sum("num_orders").cast("bigint").alias("total_orders")))
    # The mean of per-order means is kept as written.  Both levels are
    # exact DECIMAL averages, converted to double once at the end.
    disc, price = F.col("_avg_disc").cast("double"), F.col("_a_price").cast("double")
    return out.select(
        "week_date", *keys, "total_gross_margin",
        disc.alias("avg_disc"), price.alias("a_price"),
        F.try_divide(disc, price).alias("pdisc"),
        "total_units", "total_orders")


def weekly_sales(lines: DataFrame) -> DataFrame:
    """A2: per order-day aggregate, then per ISO week (Monday)."""
    return _weekly(_order_day(lines, []), [])


def weekly_sales_by_product(lines: DataFrame, skus: DataFrame) -> DataFrame:
    """A3: as A2 with the product type of each sku (left join)."""
    joined = lines.join(skus, "sku", "left")
    return _weekly(_order_day(joined, ["sku", "product_type"]), ["product_type"])


def first_order_profile(profiles: DataFrame, lines: DataFrame, cutoff: str,
                        side: str = "before") -> DataFrame:
    """A4: first-order measures per customer, split on last order date.

    X9 kept: the inner group is by order date while only its month is kept,
    and the outer sums run over that fan-out.  ``side`` is ``before``
    (``lo_date < cutoff``) or ``after`` (``>=``).
    """
    cp = profiles.alias("cp")
    olr = lines.alias("olr")
    fo = (cp.join(olr, F.col("olr.order_id") == F.col("cp.first_order_id"), "left")
            .groupBy(F.col("cp.unique_customer_id").alias("unique_customer_id"),
                     F.col("cp.first_order_id"), F.col("cp.last_order_id"),
                     F.col("olr.order_date"),
                     F.col("cp.first_order_fc_channel").alias("fo_channel"),
                     F.col("cp.first_order_fc_vendor").alias("fo_vendor"))
            .agg(F.month("olr.order_date").alias("fo_date"),
                 F.sum("olr.gross_margin").alias("fo_gross_margin"),
                 F.sum("olr.num_units").alias("fo_num_units"),
                 F.sum("olr.discount_amount").alias("fo_discount_amt"),
                 F.sum("olr.shipping_amount").alias("fo_shipping_amt"),
                 F.sum("olr.refund_amount").alias("fo_refund_amt"))
            .drop("order_date", "first_order_id", "last_order_id"))
    lo = F.col("cp.last_order_date")
    cond = lo < F.lit(cutoff).cast("date") if side == "before" else lo >= F.lit(cutoff).cast("date")
    joined = (profiles.alias("cp").where(cond)
              .join(fo.alias("fo"), F.col("cp.unique_customer_id") == F.col("fo.unique_customer_id"), "left"))
    refund_flag = F.when(F.col("fo.fo_refund_amt") > 0, 1).otherwise(0)
    return (joined.groupBy(F.col("cp.unique_customer_id").alias("unique_customer_id"),
                           lo.alias("lo_date"), F.col("fo.fo_channel").alias("fo_channel"),
                           F.col("fo.fo_vendor").alias("fo_vendor"), F.col("fo.fo_date").alias("fo_date"),
                           refund_flag.alias("refund_flag"))
                  .agg(F.sum("fo.fo_gross_margin").alias("fo_gross_margin"),
                       F.sum("fo.fo_num_units").cast("bigint").alias("fo_num_units"),
                       F.sum("fo.fo_discount_amt").alias("fo_discount_amt"),
                       F.sum("fo.fo_shipping_amt").alias("fo_shipping_amt"),
                       F.sum("fo.fo_refund_amt").alias("fo_refund_amt"),
                       F.sum("cp.gross_margin").alias("total_gross_margin"),
                       F.sum("cp.num_orders").cast("bigint").alias("number_orders")))
