"""Customer lifetime value.

Pipeline: transactions -> RFM summary (two-level aggregate) -> BG/NBD and
Gamma-Gamma maximum likelihood -> per-customer predictions -> CLV.

Scale notes
* ``rfm_summary`` is a partial+final aggregate per (customer, period) and
  then per customer: one shuffle on ``customer_id``.
* The BG/NBD likelihood depends on a customer only through (x, t_x, T); the
  fit first groups customers to those distinct triples (a size bounded by
  the period grid, not by the number of customers).  If the grouped table is
  within ``max_driver_rows`` it is fitted in numpy on the driver, otherwise
  every iteration is one distributed aggregate that scores a whole stencil of
  candidate parameters in a single pass.
* Gamma-Gamma has a continuous per-customer mean, so it is always fitted by
  the distributed aggregate path.
* Predictions are column expressions, except the 2F1 series which runs in
  one Arrow-batched pandas UDF.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custos.functions.optim import newton_minimize
from custos.functions.special import hyp2f1_np, lgamma_col, lgamma_np, rising_log_col

# Length of a period in days (numpy's mean month / week / day)
# and the CLV step factor per frequency.
MONTH_DAYS = 30.436875
PERIOD_DAYS = {"D": 1.0, "W": 7.0, "M": MONTH_DAYS}
CLV_FACTOR = {"W": 4.345, "M": 1.0, "D": 30.0}


def period_start(c: Column, freq: str) -> Column:
    if freq == "D":
        return c.cast("date")
    if freq == "W":
        return F.date_trunc("week", c).cast("date")
    if freq == "M":
        return F.date_trunc("month", c).cast("date")
    raise ValueError(f"unsupported freq {freq!r}")


def rfm_summary(tx: DataFrame, end, customer_col: str = "customer_id", date_col: str = "date",
                value_col: str | None = "amount", freq: str = "M", cap: float | None = None,
                month_days: float = MONTH_DAYS) -> DataFrame:
    """Frequency, recency, T and monetary value per customer.

    ``end`` is a date literal or a Column (e.g. a scalar-subquery result).
    Transactions after the period containing ``end`` are dropped; repeat
    periods are counted once; ``monetary_value`` is the mean of per-period
    totals excluding the first period (0 when there is none).
    """
    days = month_days if freq == "M" else PERIOD_DAYS[freq]
    end_p = period_start(F.lit(end).cast("date") if not isinstance(end, Column) else end, freq)
    value = F.col(value_col) if value_col else F.lit(0.0)
    per = (tx.select(F.col(customer_col).alias("customer_id"),
                     period_start(F.col(date_col), freq).alias("p"), value.alias("v"))
             .where(F.col("p") <= end_p)
             .groupBy("customer_id", "p").agg(F.sum("v").alias("v")))
    first = F.min("p")
    cust = (per.groupBy("customer_id")
               .agg(first.alias("p_min"), F.max("p").alias("p_max"),
                    F.count("*").alias("n"),
                    # periods per customer are bounded by the calendar; folding
                    # them in period order makes the double sum reproducible
                    # whatever the partitioning
                    F.array_sort(F.collect_list(F.struct("p", "v"))).alias("pv")))
    freq_col = (F.col("n") - 1).cast("bigint")
    rest = F.aggregate(F.slice(F.col("pv"), 2, F.greatest(F.col("n") - 1, F.lit(1))),
                       F.lit(0.0), lambda acc, e: acc + e["v"].cast("double"))
    monetary = F.when(freq_col > 0, rest / freq_col).otherwise(F.lit(0.0))
    out = cust.select(
        "customer_id",
        freq_col.alias("frequency"),
        (F.datediff("p_max", "p_min").cast("double") / days).alias("recency"),
        (F.datediff(end_p, "p_min").cast("double") / days).alias("T"),
        monetary.alias("monetary_value"))
    if cap is not None:
        out = out.where(F.col("monetary_value") < cap)
    return out


@dataclass(frozen=True)
class BGParams:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GGParams:
    p: float
    q: float
    v: float


def p_alive(x: Column, tx: Column, t: Column, m: BGParams) -> Column:
    """C4: probability the customer is still active (1 when x = 0)."""
    ratio = F.pow((F.lit(m.alpha) + t) / (F.lit(m.alpha) + tx), F.lit(m.r) + x)
    return F.when(x == 0, F.lit(1.0)).otherwise(
        1.0 / (1.0 + F.lit(m.a) / (F.lit(m.b) + x - 1.0) * ratio))


def with_p_alive(rfm: DataFrame, m: BGParams, digits: int | None = 6) -> DataFrame:
    c = p_alive(F.col("frequency"), F.col("recency"), F.col("T"), m)
    return rfm.withColumn("probability_alive", F.round(c, digits) if digits else c)


def expected_purchases_np(t, x, tx, T_, m: BGParams):
    """E[Y(t) | x, t_x, T] (Fader, Hardie & Lee 2005, eq. 10)."""
    x, tx, T_, t = (np.asarray(v, dtype="float64") for v in (x, tx, T_, t))
    r, alpha, a, b = m.r, m.alpha, m.a, m.b
    z = t / (alpha + T_ + t)
    hyp = hyp2f1_np(r + x, b + x, a + b + x - 1.0, z)
    first = (a + b + x - 1.0) / (a - 1.0)
    second = 1.0 - ((alpha + T_) / (alpha + T_ + t)) ** (r + x) * hyp
    denom = 1.0 + np.where(x > 0, a / (b + np.maximum(x, 1.0) - 1.0) * ((alpha + T_) / (alpha + tx)) ** (r + x), 0.0)
    return first * second / denom


def expected_purchases(x: Column, tx: Column, t_col: Column, t: float | Column, m: BGParams) -> Column:
    @F.pandas_udf(T.DoubleType())
    def _ey(xs: pd.Series, txs: pd.Series, Ts: pd.Series, ts: pd.Series) -> pd.Series:
        return pd.Series(expected_purchases_np(ts.to_numpy(), xs.to_numpy(), txs.to_numpy(), Ts.to_numpy(), m))
    tcol = t if isinstance(t, Column) else F.lit(float(t))
    return _ey(x.cast("double"), tx.cast("double"), t_col.cast("double"), tcol.cast("double"))


# ---------------------------------------------------------------- BG/NBD fit
def bg_log_likelihood_np(points: np.ndarray, x, tx, T_, w) -> np.ndarray:
    """Weighted log-likelihood sums of rows (x, t_x, T, weight), one per row of log-parameters."""
    out = np.zeros(len(points))
    repeat = x > 0
    xi = x.astype(int)
    ks = np.arange(max(int(xi.max(initial=0)), 1))
    rising = lambda base: np.concatenate([[0.0], np.cumsum(np.log(base + ks))])[xi]
    for i, (r, alpha, a, b) in enumerate(np.exp(points)):
        alive = -(r + x) * np.log(alpha + T_)
        left = np.where(repeat, np.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + tx), -np.inf)
        out[i] = w @ (rising(r) + r * np.log(alpha) + rising(b) - rising(a + b) + np.logaddexp(alive, left))
    return out


def _summed(rows: DataFrame, cols, fn, points: np.ndarray) -> np.ndarray:
    """Sum of ``fn(points, *columns)`` (a value per point) over all rows, by task; one row of sums a task is added up here."""
    def run(parts):
        yield pd.DataFrame({"s": [sum((fn(points, *(p[c].to_numpy() for c in cols)) for p in parts), np.zeros(len(points)))]})
    return np.sum([r["s"] for r in rows.mapInPandas(run, "s array<double>").collect()], axis=0)


def gg_row_terms_np(points: np.ndarray, x, m) -> np.ndarray:
    """Sums of (p x + q) ln(x m + v), one per row of log-parameters."""
    return np.array([(p * x + q) @ np.log(x * m + v) for p, q, v in np.exp(points)])


def fit_bgnbd(rfm: DataFrame, penalizer: float = 0.0, tol: float = 1e-9) -> BGParams:
    """Maximum-likelihood BG/NBD parameters (r, alpha, a, b).

    Customers are counted per distinct (x, t_x, T); every task sums the
    likelihoods of its part for a batch of points.  Time is rescaled so that
    max(T) = 10 during the fit (alpha is unscaled afterwards), parameters are
    searched in log space.
    """
    counted = rfm.groupBy("frequency", "recency", "T").agg(F.count("*").cast("double").alias("w")).persist()
    tmax, total = counted.agg(F.max("T"), F.sum("w")).first()
    if not total:
        counted.unpersist()
        raise ValueError("no customers to fit")
    scale = 10.0 / float(tmax or 1.0)
    grouped = counted.select(F.col("frequency").cast("double").alias("x"), (F.col("recency") * scale).alias("tx"),
                             (F.col("T") * scale).alias("T"), "w")

    def objective(points):
        sums = _summed(grouped, ("x", "tx", "T", "w"), bg_log_likelihood_np, points)
        return penalizer * (np.exp(points) ** 2).sum(axis=1) - sums / total
    best, _, _ = newton_minimize(objective, np.zeros(4), tol=tol)
    counted.unpersist()
    r, alpha, a, b = np.exp(best)
    return BGParams(float(r), float(alpha / scale), float(a), float(b))


# ----------------------------------------------------------- Gamma-Gamma fit
def fit_gamma_gamma(rfm: DataFrame, penalizer: float = 0.0, tol: float = 1e-9) -> GGParams:
    """Gamma-Gamma spend model on repeat customers (frequency > 0, monetary > 0).

    The log-likelihood splits into terms that depend on a customer only
    through the integer frequency x (grouped once per distinct x, a table
    bounded by the largest frequency) and one per-customer term
    (p x + q) ln(x m + v), summed for a batch of points in one aggregate.
    Money is divided by its mean during the fit (v is scaled back), so that a
    penalty means the same in every currency.
    """
    rows = (rfm.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
               .select(F.col("frequency").cast("double").alias("x"),
                       F.col("monetary_value").cast("double").alias("m")).persist())
    mean = rows.agg(F.avg("m")).first()[0]
    if mean is None:
        rows.unpersist()
        raise ValueError("no repeat customers to fit")
    scaled = rows.withColumn("m", F.col("m") / mean)
    xs = scaled.groupBy("x").agg(F.count("*").alias("nx"), F.sum(F.log("m")).alias("slnm")).toPandas()
    n = float(xs["nx"].sum())
    x, nx, slnm = (xs[c].to_numpy(dtype="float64") for c in ("x", "nx", "slnm"))

    def obj(batch):
        row_terms = _summed(scaled, ("x", "m"), gg_row_terms_np, batch)
        out = []
        for i, th in enumerate(batch):
            p_, q_, v_ = np.exp(th)
            px = p_ * x
            grouped = float(np.sum(nx * (lgamma_np(px + q_) - lgamma_np(px) - lgamma_np(q_) + q_ * np.log(v_)
                                         + px * np.log(x)) + (px - 1.0) * slnm))
            ll = grouped - row_terms[i]
            out.append(-(ll / n) + penalizer * float((np.exp(th) ** 2).sum()) if np.isfinite(ll) else np.inf)
        return np.array(out)
    best, _, _ = newton_minimize(obj, np.zeros(3), tol=tol)
    rows.unpersist()
    p, q, v = np.exp(best)
    return GGParams(float(p), float(q), float(v * mean))


def expected_profit(x: Column, m: Column, g: GGParams) -> Column:
    """Conditional expected average profit."""
    pop = g.p * g.v / (g.q - 1.0)
    w = (F.lit(g.p) * x) / (F.lit(g.p) * x + g.q - 1.0)
    return w * m + (1.0 - w) * pop


def clv(rfm: DataFrame, bg: BGParams, gg: GGParams, months: int = 12, discount: float = 0.01,
        freq: str = "M", digits: int = 3) -> DataFrame:
    """Discounted CLV; the horizon is exploded to (customer, step) rows and summed."""
    factor = CLV_FACTOR[freq]
    steps = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("i")
    base = rfm.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
    long = base.select("*", steps)
    t_hi = F.col("i").cast("double") * factor
    e_hi = expected_purchases(F.col("frequency"), F.col("recency"), F.col("T"), t_hi, bg)
    e_lo = expected_purchases(F.col("frequency"), F.col("recency"), F.col("T"), t_hi - factor, bg)
    profit = expected_profit(F.col("frequency").cast("double"), F.col("monetary_value"), gg)
    contrib = profit * (e_hi - e_lo) / F.pow(F.lit(1.0 + discount), F.col("i").cast("double"))
    keys = base.columns
    return (long.withColumn("_c", contrib).groupBy(*keys)
                .agg(F.round(F.sum("_c"), digits).alias("predicted_cltv"))
                .withColumn("exp_profit", F.round(profit, digits)))


# --------------------------------------------------------- holdout and tables
def holdout(tx: DataFrame, days: int = 365, date_col: str = "date") -> DataFrame:
    """Per-customer count and sum strictly inside (max - days, max)."""
    end = tx.agg(F.max(date_col)).scalar()  # uncorrelated scalar subquery (J8)
    inside = (tx.withColumn("hold_begin", F.date_sub(end, days)).withColumn("hold_end", end)
                .where((F.col(date_col) > F.col("hold_begin")) & (F.col(date_col) < F.col("hold_end"))))
    return (inside.groupBy("customer_id", "hold_begin", "hold_end")
                  .agg(F.count("orders").alias("trxn"), F.sum("amount").alias("amount")))


def merge_holdout(scored: DataFrame, hold: DataFrame, thresh: float) -> tuple[DataFrame, DataFrame]:
    """Inner join and the thresholded copy."""
    merged = scored.join(hold, "customer_id")
    return merged, merged.where((F.col("predicted_cltv") < thresh) & (F.col("amount") < thresh))


def calibration_holdout(tx: DataFrame, cal_end, obs_end, freq: str = "M",
                        date_col: str = "date", month_days: float = MONTH_DAYS) -> DataFrame:
    """RFM on the calibration window plus holdout period counts."""
    cal_end_c = F.lit(cal_end).cast("date") if not isinstance(cal_end, Column) else cal_end
    obs_end_c = F.lit(obs_end).cast("date") if not isinstance(obs_end, Column) else obs_end
    cal = rfm_summary(tx.where(F.col(date_col) <= cal_end_c), cal_end_c, date_col=date_col,
                      value_col=None, freq=freq, month_days=month_days)
    cal = cal.select("customer_id", F.col("frequency").alias("frequency_cal"),
                     F.col("recency").alias("recency_cal"), F.col("T").alias("T_cal"))
    hold = (tx.where((F.col(date_col) > cal_end_c) & (F.col(date_col) <= obs_end_c))
              .groupBy("customer_id")
              .agg(F.count_distinct(period_start(F.col(date_col), freq)).alias("frequency_holdout")))
    if freq == "M":
        dur = (F.year(obs_end_c) - F.year(cal_end_c)) * 12 + F.month(obs_end_c) - F.month(cal_end_c)
    else:
        dur = F.floor(F.datediff(period_start(obs_end_c, freq), period_start(cal_end_c, freq)) / PERIOD_DAYS[freq])
    return (cal.join(hold, "customer_id", "left")
               .select("customer_id", "frequency_cal", "recency_cal", "T_cal",
                       F.coalesce("frequency_holdout", F.lit(0)).cast("bigint").alias("frequency_holdout"),
                       dur.cast("double").alias("duration_holdout")))


def ltv_valid(cal_hold: DataFrame, bg: BGParams, t: float = 12, max_freq: int = 7) -> DataFrame:
    """C11: mean predicted vs mean holdout purchases per calibration frequency."""
    pred = expected_purchases(F.col("frequency_cal"), F.col("recency_cal"), F.col("T_cal"), t, bg)
    out = (cal_hold.where(F.col("frequency_cal") < max_freq)
                   .withColumn("predicted_purchases", pred)
                   .groupBy("frequency_cal")
                   .agg(F.round(F.avg("predicted_purchases"), 2).alias("predicted"),
                        F.avg("frequency_holdout").alias("holdout")))
    return (out.withColumn("diff", F.col("predicted") - F.col("holdout"))
               .withColumn("percent_error", F.try_divide("diff", "holdout")))


def repeat_distribution(rfm: DataFrame, top: int = 7) -> DataFrame:
    """Customers per frequency 0..top (top = top and above)."""
    return (rfm.groupBy(F.least(F.col("frequency"), F.lit(top)).cast("bigint").alias("frequency"))
               .agg(F.count("*").alias("customers")))


def alive_matrix(rfm: DataFrame, m: BGParams, digits: int = 6) -> DataFrame:
    """C17: P(alive) over the frequency x recency grid of the fitted data."""
    bounds = rfm.agg(F.max("frequency").cast("int").alias("fmax"), F.floor(F.max("T")).cast("int").alias("tmax"))
    grid = (bounds.select(F.explode(F.sequence(F.lit(0), "fmax")).alias("frequency"), "tmax")
                  .select("frequency", F.explode(F.sequence(F.lit(0), "tmax")).alias("recency"), "tmax"))
    pa = p_alive(F.col("frequency").cast("double"), F.col("recency").cast("double"),
                 F.col("tmax").cast("double"), m)
    return grid.select(F.col("frequency").cast("bigint").alias("frequency"),
                       F.col("recency").cast("bigint").alias("recency"),
                       F.round(pa, digits).alias("probability_alive"))


def frequency_recency_matrix(rfm: DataFrame, m: BGParams, t: float = 1.0, digits: int = 6) -> DataFrame:
    """C17: expected purchases in the next ``t`` periods over the same grid."""
    bounds = rfm.agg(F.max("frequency").cast("int").alias("fmax"), F.floor(F.max("T")).cast("int").alias("tmax"))
    grid = (bounds.select(F.explode(F.sequence(F.lit(0), "fmax")).alias("frequency"), "tmax")
                  .select("frequency", F.explode(F.sequence(F.lit(0), "tmax")).alias("recency"), "tmax"))
    ey = expected_purchases(F.col("frequency"), F.col("recency"), F.col("tmax"), t, m)
    return grid.select(F.col("frequency").cast("bigint").alias("frequency"),
                       F.col("recency").cast("bigint").alias("recency"),
                       F.round(ey, digits).alias("expected_purchases"))


def segment_labels(profile: DataFrame) -> DataFrame:
    """X10 (documented divergence): label clusters by recency rank, not raw id."""
    labels = F.create_map(F.lit(0), F.lit("LVC"), F.lit(1), F.lit("Avg. Cust."), F.lit(2), F.lit("HVC"))
    return profile.withColumn("segment", labels[F.col("new_cl_id")])


def score_customers(clv_df: DataFrame, tx: DataFrame, clusters: DataFrame | None = None,
                    seed: int = 42, wholesale_at: float = 1000.0) -> DataFrame:
    """Scoring table: first email per customer, flags, rounded trxn, anonymised email."""
    # first customer per email (aggregate, so a hot email is reduced map-side)
    first_email = (tx.groupBy("email").agg(F.min_by("customer_id", F.struct("date", "customer_id")).alias("customer_id"))
                     .select("customer_id", "email"))
    out = clv_df.join(first_email, "customer_id")
    if clusters is not None:
        out = out.join(clusters, "customer_id")
    return (out.withColumn("wholesaler", F.when(F.col("predicted_cltv") < wholesale_at, 0).otherwise(1))
               .withColumn("churn_group", F.when(F.col("probability_alive") < 0.5, 0).otherwise(1))
               .withColumn("pred_trxn", F.bround("predicted_num_trxn", 0))
               .withColumn("email_anonymous",
                           F.array_join(F.shuffle(F.split("email", ""), F.lit(seed)), "")))


def summary_by_trx(scored: DataFrame) -> DataFrame:
    """C14: mean CLV and share of customers per predicted transactions (wholesalers excluded)."""
    kept = scored.where(F.col("wholesaler") != 1)
    g = kept.groupBy("pred_trxn").agg(F.avg("predicted_cltv").alias("predicted_cltv"),
                                      F.count("*").alias("n"))
    total = kept.agg(F.count("*")).scalar()
    return g.select("pred_trxn", "predicted_cltv", (F.col("n") / total).alias("percent_total"))
