"""Registered queries: window and time-series operators.

``daily_pair`` is one long series (no key): those queries exercise the
parallel halo layout.  ``event_daily`` has five series keyed by
``series_id``: those run one window partition per series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from custos.operators import timeseries as ts
from custos.plans import sqlhelp
from custos.plans.registry import register
from custos.sources.fixtures import fixture, with_views

COM_ALPHA = 1.0 / 1.5            # W3: com = 0.5
SPAN = lambda s: 2.0 / (s + 1)


def daily(spark, sf):
    d = fixture(spark, sf, "daily_pair")
    return d.select("dt", F.col("river").cast("decimal(18,2)").alias("river"),
                    F.col("off_river").cast("decimal(18,2)").alias("off_river"))


_DAILY = "d AS (SELECT dt, cast(river AS decimal(18,2)) AS river, cast(off_river AS decimal(18,2)) AS off_river FROM daily_pair)"


def _dsql(body: str) -> str:
    return with_views(f"WITH {_DAILY}\n{body}", "daily_pair")


def _esql(body: str) -> str:
    return with_views(body, "event_daily")


# ---------------------------------------------------------------- rolling
@register("daily_rolling_mean", _dsql("""
SELECT dt, river, off_river,
  CASE WHEN count(river) OVER w5 = 5 THEN cast(sum(river) OVER w5 AS double) / 5.0 END AS mean5_river,
  CASE WHEN count(river) OVER w21 = 21 THEN cast(sum(river) OVER w21 AS double) / 21.0 END AS mean21_river
FROM d WINDOW w5 AS (ORDER BY dt ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
              w21 AS (ORDER BY dt ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)"""))
def daily_rolling_mean(spark, sf):
    return ts.rolling(daily(spark, sf), [], "dt", "river", (5, 21), "mean")


def _sd_sql(n):
    return (f"CASE WHEN count(river) OVER w{n} = {n} THEN sqrt(greatest(cast(sum(river * river) OVER w{n} * {n} "
            f"- sum(river) OVER w{n} * sum(river) OVER w{n} AS double), 0.0) / {float(n * (n - 1))}) END AS sd{n}_river")


@register("daily_rolling_sd", _dsql(f"""
SELECT dt, river, off_river, {_sd_sql(12)}, {_sd_sql(20)}
FROM d WINDOW w12 AS (ORDER BY dt ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
              w20 AS (ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""))
def daily_rolling_sd(spark, sf):
    return ts.rolling(daily(spark, sf), [], "dt", "river", (12, 20), "sd")


@register("event_rolling_mean", _esql("""
SELECT series_id, dt, value, n,
  CASE WHEN count(value) OVER w = 7 THEN cast(sum(value) OVER w AS double) / 7.0 END AS mean7_value
FROM event_daily WINDOW w AS (PARTITION BY series_id ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def event_rolling_mean(spark, sf):
    return ts.rolling(fixture(spark, sf, "event_daily"), ["series_id"], "dt", "value", (7,), "mean")


# -------------------------------------------------------------------- ewm
def _ewm_sql(col: str, alpha: float, adjust: bool, name: str, part: str = "", order: str = "dt") -> str:
    k = ts.ewm_window(alpha)
    w = f"{1.0 - alpha!r}::DOUBLE"
    alpha_s = f"{alpha!r}::DOUBLE"
    win = f"({part} ORDER BY {order} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    lst = f"list(cast({col} AS double)) OVER {win}"
    if adjust:
        num = f"list_reduce({lst}, lambda a, x: a * {w} + x, 0.0::DOUBLE)"
        den = f"list_reduce(list_transform({lst}, lambda x: 1.0::DOUBLE), lambda a, x: a * {w} + x, 0.0::DOUBLE)"
        return f"CASE WHEN {col} IS NOT NULL THEN {num} / {den} END AS {name}"
    rn = f"(row_number() OVER ({part} ORDER BY {order}) - 1)"
    start = f"CASE WHEN {rn} < {k} THEN ({lst})[1] ELSE ({lst})[1] * {alpha_s} END"
    body = f"list_reduce(({lst})[2:], lambda a, x: a * {w} + x * {alpha_s}, {start})"
    return f"CASE WHEN {col} IS NOT NULL THEN {body} END AS {name}"


@register("daily_ewm", _dsql(f"SELECT dt, river, off_river, {_ewm_sql('river', COM_ALPHA, True, 'ewm_river')} FROM d"))
def daily_ewm(spark, sf):
    return ts.ewm(daily(spark, sf), [], "dt", "river", COM_ALPHA, adjust=True)


@register("daily_macd", _dsql(f"""
SELECT *, ema12_river - ema26_river AS macd_river FROM (
  SELECT dt, river, off_river, {_ewm_sql('river', SPAN(12), False, 'ema12_river')},
    {_ewm_sql('river', SPAN(26), False, 'ema26_river')} FROM d)"""))
def daily_macd(spark, sf):
    return ts.macd(daily(spark, sf), [], "dt", "river")


@register("daily_rsi", _dsql(f"""
, mv AS (SELECT dt, river, off_river, river - lag(river) OVER (ORDER BY dt) AS delta FROM d),
ud AS (SELECT dt, river, off_river, CASE WHEN delta > 0 THEN cast(delta AS double) ELSE 0.0 END AS up,
         abs(CASE WHEN delta < 0 THEN cast(delta AS double) ELSE 0.0 END) AS dn FROM mv WHERE delta IS NOT NULL),
e AS (SELECT dt, river, off_river, {_ewm_sql('up', SPAN(14), True, 'eu')}, {_ewm_sql('dn', SPAN(14), True, 'ed')} FROM ud)
SELECT dt, river, off_river, 100.0 - 100.0 / (1.0 + eu / nullif(ed, 0.0)) AS rsi_river FROM e
UNION ALL SELECT dt, river, off_river, NULL FROM mv WHERE delta IS NULL"""))
def daily_rsi(spark, sf):
    return ts.rsi(daily(spark, sf), [], "dt", "river", 14, "standard")


@register("event_ewm", _esql(f"""
SELECT series_id, dt, value, n, {_ewm_sql('value', SPAN(5), True, 'ewm_value', 'PARTITION BY series_id')} FROM event_daily"""))
def event_ewm(spark, sf):
    return ts.ewm(fixture(spark, sf, "event_daily"), ["series_id"], "dt", "value", SPAN(5), adjust=True)


# ----------------------------------------------------------- lags & co
@register("daily_lags", _dsql("""
SELECT dt, river, off_river, lag(river, 1) OVER w AS river_lag1, lag(river, 2) OVER w AS river_lag2,
  river - lag(river, 1) OVER w AS river_diff,
  coalesce(cast(river - lag(river, 1) OVER w > 0 AS integer), 0) AS river_up
FROM d WINDOW w AS (ORDER BY dt)"""))
def daily_lags(spark, sf):
    return ts.lags(daily(spark, sf), [], "dt", ["river"], (1, 2))


def _dow_cols(spark_df):
    iso = (F.dayofweek("dt") + 5) % 7 + 1
    for i in range(1, 6):
        spark_df = spark_df.withColumn(f"m{i}", F.when(iso == i, 1).otherwise(0))
    return spark_df


@register("daily_interactions", _dsql(", dm AS (SELECT *, " + ", ".join(
    f"CASE WHEN isodow(dt) = {i} THEN 1 ELSE 0 END AS m{i}" for i in range(1, 6)) + " FROM d)\nSELECT *, " + ", ".join(
    f"coalesce(lag(m{i} * {x}, 1) OVER (ORDER BY dt), 0) AS m{i}_x_{x}" for x in ("river", "off_river")
    for i in range(1, 6)) + " FROM dm"))
def daily_interactions(spark, sf):
    d = _dow_cols(daily(spark, sf))
    return ts.interactions(d, [], "dt", ["river", "off_river"], [f"m{i}" for i in range(1, 6)])


@register("daily_design_matrix", _dsql("""
SELECT dt, river_l1, river_l2, river_l3, off_river_l1, off_river_l2 FROM (
  SELECT dt, lag(river, 1) OVER w AS river_l1, lag(river, 2) OVER w AS river_l2, lag(river, 3) OVER w AS river_l3,
    lag(off_river, 1) OVER w AS off_river_l1, lag(off_river, 2) OVER w AS off_river_l2,
    row_number() OVER w - 1 AS idx FROM d WINDOW w AS (ORDER BY dt)) WHERE idx >= 3"""))
def daily_design_matrix(spark, sf):
    return ts.design_matrix(daily(spark, sf), [], "dt", {"river": 3, "off_river": 2}, [])


@register("daily_lookback", _dsql("""
SELECT dt, win AS window, cast(river AS double) AS target FROM (
  SELECT dt, river, list([cast(river AS double), cast(off_river AS double)]) OVER
    (ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS win, lead(dt) OVER (ORDER BY dt) AS nxt FROM d)
WHERE len(win) = 7 AND nxt IS NOT NULL"""))
def daily_lookback(spark, sf):
    return ts.lookback(daily(spark, sf), [], "dt", ["river", "off_river"], "river", 7)


def _acf_sql(col: str, nlags: int, part: str, src: str, keys: str) -> str:
    kk = f"{keys}, " if keys else ""
    prods = ", ".join(f"d * lag(d, {k}) OVER (PARTITION BY {part} ORDER BY dt) AS p{k}" if part else
                      f"d * lag(d, {k}) OVER (ORDER BY dt) AS p{k}" for k in range(1, nlags + 1))
    sums = ", ".join(f"sum(p{k}) AS s{k}" for k in range(1, nlags + 1))
    unp = " UNION ALL ".join(f"SELECT {kk}{k} AS lag, s{k} AS num, s0 AS den, nobs AS n FROM s" for k in range(0, nlags + 1))
    mean = (f"(SELECT {keys}, avg(cast({col} AS double)) AS m, count({col}) AS nobs FROM {src} GROUP BY {keys})"
            if keys else f"(SELECT avg(cast({col} AS double)) AS m, count({col}) AS nobs FROM {src})")
    join = f"JOIN {mean} mm USING ({keys})" if keys else f", {mean} mm"
    return f""", x AS (SELECT t.*, cast({col} AS double) - m AS d, nobs FROM {src} t {join}),
pr AS (SELECT *, {prods} FROM x),
s AS (SELECT {kk}nobs, sum(d * d) AS s0, {sums} FROM pr GROUP BY {kk}nobs)
SELECT {kk}cast(lag AS integer) AS lag, round(num / den, 6) AS acf, round(1.96 / sqrt(cast(n AS double)), 6) AS band
FROM ({unp})"""


@register("daily_acf", _dsql(_acf_sql("river", 20, "", "d", "")))
def daily_acf(spark, sf):
    return ts.acf(daily(spark, sf), [], "dt", "river", 20)


@register("event_acf", with_views("WITH e AS (SELECT * FROM event_daily)" + _acf_sql("value", 5, "series_id", "e", "series_id"),
                                  "event_daily"))
def event_acf(spark, sf):
    return ts.acf(fixture(spark, sf, "event_daily"), ["series_id"], "dt", "value", 5)


def monthly_series(spark, sf):
    m = fixture(spark, sf, "monthly_sales")
    return m.select(F.col("month").alias("dt"), "sales", "intent", "spend")


_MONTHLY = "ms AS (SELECT month AS dt, sales, intent, spend FROM monthly_sales)"


@register("monthly_ljung_box", with_views(f"WITH {_MONTHLY}" + _acf_sql("sales", 7, "", "ms", "").replace(
    "SELECT cast(lag AS integer) AS lag, round(num / den, 6) AS acf",
    ", a AS (SELECT cast(lag AS integer) AS lag, round(num / den, 6) AS acf, n") + """)
SELECT round(max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)), 6) AS q, 7 AS df FROM a WHERE lag BETWEEN 1 AND 7""",
    "monthly_sales"))
def monthly_ljung_box(spark, sf):
    m = monthly_series(spark, sf)
    a = ts.acf(m, [], "dt", "sales", 7)
    n = m.agg(F.count("sales")).scalar()
    return ts.ljung_box(a, n, 7, 0)


@register("monthly_decompose", with_views(f"""WITH {_MONTHLY},
t AS (SELECT dt, sales, row_number() OVER (ORDER BY dt) - 1 AS idx,
  CASE WHEN count(sales) OVER w = 13 THEN (sum(cast(sales AS double)) OVER w - 0.5 * first_value(cast(sales AS double)) OVER w
       - 0.5 * last_value(cast(sales AS double)) OVER w) / 12 END AS trend
  FROM ms WINDOW w AS (ORDER BY dt ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
p AS (SELECT idx % 12 AS phase, avg(cast(sales AS double) - trend) AS sm FROM t GROUP BY 1),
c AS (SELECT phase, sm - (SELECT avg(sm) FROM p) AS seasonal FROM p)
SELECT dt, round(trend, 2) AS trend, round(seasonal, 2) AS seasonal, round(cast(sales AS double) - trend - seasonal, 2) AS remainder
FROM t LEFT JOIN c ON t.idx % 12 = c.phase""", "monthly_sales"))
def monthly_decompose(spark, sf):
    return ts.decompose(monthly_series(spark, sf), [], "dt", "sales", 12, digits=2)


@register("daily_future_dates", _dsql("""
SELECT cast(d AS date) AS dt, cast(rn - 1 AS integer) AS step FROM (
  SELECT d, row_number() OVER (ORDER BY d) AS rn FROM (
    SELECT unnest(generate_series(mx, mx + INTERVAL 16 DAY, INTERVAL 1 DAY)) AS d FROM (SELECT max(dt) AS mx FROM d))
  WHERE isodow(d) < 6) WHERE rn > 1 AND rn <= 4"""))
def daily_future_dates(spark, sf):
    return ts.future_dates(daily(spark, sf), [], "dt", 3, "B")


@register("daily_last_n", _dsql("SELECT * FROM d ORDER BY dt DESC LIMIT 30"))
def daily_last_n(spark, sf):
    return ts.last_n(daily(spark, sf), [], "dt", 30)


@register("event_last_n", _esql("""
SELECT series_id, dt, value, n FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) AS rn
FROM event_daily) WHERE rn <= 5"""))
def event_last_n(spark, sf):
    return ts.last_n(fixture(spark, sf, "event_daily"), ["series_id"], "dt", 5)


def daily_forecast(spark, sf):
    """Daily series with a naive seasonal forecast (value one week earlier)."""
    from pyspark.sql import Window
    d = daily(spark, sf)
    return d.withColumn("forecast", F.lag("river", 7).over(Window.orderBy("dt")))


_FC = ", fc AS (SELECT *, lag(river, 7) OVER (ORDER BY dt) AS forecast FROM d)"


def _daily_fc(spark, sf):
    d = daily(spark, sf)
    return ts.lags(d, [], "dt", ["river"], (7,), diff=False, direction=False).withColumnRenamed("river_lag7", "forecast")


_CONF = """, dd AS (SELECT river - lag(river) OVER (ORDER BY dt) AS da, forecast - lag(forecast) OVER (ORDER BY dt) AS dp FROM fc),
conf AS (SELECT cast(da > 0 AS integer) AS actual_up, cast(dp > 0 AS integer) AS pred_up, count(*) AS count,
  (SELECT count(*) FROM fc) AS n_rows FROM dd WHERE da IS NOT NULL AND dp IS NOT NULL GROUP BY 1, 2)"""


@register("daily_direction_confusion", _dsql(_FC + _CONF + "\nSELECT *, count / n_rows AS rate FROM conf"))
def daily_direction_confusion(spark, sf):
    return ts.direction_confusion(_daily_fc(spark, sf), [], "dt", "river", "forecast")


@register("daily_direction_auc", _dsql(_FC + _CONF + """
, s AS (SELECT sum(CASE WHEN actual_up = 1 AND pred_up = 1 THEN count ELSE 0 END) AS tp,
  sum(CASE WHEN actual_up = 1 AND pred_up = 0 THEN count ELSE 0 END) AS fn,
  sum(CASE WHEN actual_up = 0 AND pred_up = 0 THEN count ELSE 0 END) AS tn,
  sum(CASE WHEN actual_up = 0 AND pred_up = 1 THEN count ELSE 0 END) AS fp FROM conf)
SELECT (cast(tp AS double) / cast(tp + fn AS double) + cast(tn AS double) / cast(tn + fp AS double)) / 2.0 AS auc,
  cast(tp + tn AS double) / (tp + tn + fp + fn) AS accuracy,
  greatest((cast(tp AS double) / cast(tp + fn AS double) + cast(tn AS double) / cast(tn + fp AS double)) / 2.0,
           cast(tp + tn AS double) / (tp + tn + fp + fn)) AS model_accuracy FROM s"""))
def daily_direction_auc(spark, sf):
    c = ts.direction_confusion(_daily_fc(spark, sf), [], "dt", "river", "forecast")
    return ts.direction_auc(c)


@register("daily_call_right", _dsql(_FC + """
SELECT dt, river, off_river, forecast, CASE WHEN sign(river - lag(river) OVER w) = sign(forecast - lag(river) OVER w)
  AND sign(river - lag(river) OVER w) <> 0 THEN 'yes' ELSE 'no' END AS correct FROM fc WINDOW w AS (ORDER BY dt)"""))
def daily_call_right(spark, sf):
    return ts.call_right(_daily_fc(spark, sf), [], "dt", "river", "forecast")


def _errors_sql(src: str, keys: str) -> str:
    kk = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    me_u, me_s = sqlhelp.spark_avg_units(sqlhelp.units("e", 2), 19, 2)
    mae_u, mae_s = sqlhelp.spark_avg_units(sqlhelp.units("abs(e)", 2), 19, 2)
    mse_u, mse_s = sqlhelp.spark_avg_units("cast(e * 100 AS HUGEINT) * cast(e * 100 AS HUGEINT)", 38, 4)
    sc_u, sc_s = sqlhelp.spark_avg_units(sqlhelp.units("naive", 2), 19, 2)
    mae = sqlhelp.units_to_double(mae_u, mae_s)
    mse = sqlhelp.units_to_double(mse_u, mse_s)
    group = f"GROUP BY {keys}" if keys else ""
    join = f"JOIN md USING ({keys})" if keys else ", md"
    return f""", b AS (SELECT {kk}y, cast(y - f AS decimal(18,2)) AS e, abs(y - lag(y) OVER ({part}ORDER BY dt)) AS naive,
  cast(lag(y - f) OVER ({part}ORDER BY dt) AS double) AS e_lag FROM {src}),
sc AS (SELECT {kk}{sqlhelp.units_to_double(sc_u, sc_s)} AS scale FROM b {group}),
md AS (SELECT {kk}avg(cast(e AS double)) AS me_d FROM b WHERE e IS NOT NULL {group}),
g AS (SELECT {kk}{sqlhelp.units_to_double(me_u, me_s)} AS me, {mae} AS mae, {mse} AS mse,
  avg(CASE WHEN cast(y AS double) <> 0 THEN cast(e AS double) / cast(y AS double) END) AS mpe0,
  avg(CASE WHEN cast(y AS double) <> 0 THEN abs(cast(e AS double) / cast(y AS double)) END) AS mape0,
  sum((cast(e AS double) - me_d) * (e_lag - me_d)) AS a1n, sum((cast(e AS double) - me_d) * (cast(e AS double) - me_d)) AS a1d
  FROM b {join} WHERE e IS NOT NULL {group})
SELECT {kk}me, mae, mae AS mad, mse, sqrt(mse) AS rmse, round(mpe0 * 100, 6) AS mpe, round(mape0 * 100, 6) AS mape,
  mae / nullif(scale, 0) AS mase, round(a1n / nullif(a1d, 0), 6) AS acf1 FROM g {"JOIN sc USING (" + keys + ")" if keys else ", sc"}"""


@register("daily_errors", _dsql(_FC + ", src AS (SELECT dt, river AS y, forecast AS f FROM fc)" + _errors_sql("src", "")))
def daily_errors(spark, sf):
    return ts.errors(_daily_fc(spark, sf), [], "dt", "river", "forecast")


@register("event_errors", _esql(""", src AS (SELECT series_id, dt, cast(value AS decimal(18,2)) AS y,
  cast(lag(value, 7) OVER (PARTITION BY series_id ORDER BY dt) AS decimal(18,2)) AS f FROM event_daily)""" +
                                _errors_sql("src", "series_id")))
def event_errors(spark, sf):
    e = fixture(spark, sf, "event_daily").select("series_id", "dt", F.col("value").cast("decimal(18,2)").alias("value"))
    e = ts.lags(e, ["series_id"], "dt", ["value"], (7,), diff=False, direction=False).withColumnRenamed("value_lag7", "forecast")
    return ts.errors(e, ["series_id"], "dt", "value", "forecast")


@register("daily_cum_abs_error", _dsql(_FC + """
SELECT dt, river, off_river, forecast, sum(coalesce(abs(river - forecast), 0)) OVER
  (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_abs_error FROM fc"""))
def daily_cum_abs_error(spark, sf):
    return ts.cumulative_abs_error(_daily_fc(spark, sf), [], "dt", "river", "forecast")


@register("monthly_xcorr", with_views(f"WITH {_MONTHLY}, l AS (SELECT sales, " + ", ".join(
    f"lag(cast(spend AS double), {k}) OVER (ORDER BY dt) AS x{k}" if k else "cast(spend AS double) AS x0"
    for k in range(13)) + " FROM ms), c AS (" + " UNION ALL ".join(
    f"SELECT {k} AS lag, round(corr(cast(sales AS double), x{k}), 6) AS corr FROM l" for k in range(13)) + """)
SELECT lag, corr, (SELECT arg_max(lag, (abs(corr), -lag)) FROM c) AS best_lag FROM c""", "monthly_sales"))
def monthly_xcorr(spark, sf):
    return ts.xcorr_lag(monthly_series(spark, sf), [], "dt", "sales", "spend", 12)


def _holiday_sql() -> str:
    fixed = " UNION ALL ".join(
        f"SELECT CASE WHEN isodow(make_date(y, {m}, {d})) = 6 THEN make_date(y, {m}, {d}) - 1 "
        f"WHEN isodow(make_date(y, {m}, {d})) = 7 THEN make_date(y, {m}, {d}) + 1 ELSE make_date(y, {m}, {d}) END AS h FROM yrs"
        for _, m, d in ts.FIXED_HOLIDAYS)
    nth = []
    for _, m, wd, k in ts.NTH_WEEKDAY_HOLIDAYS:
        iso = wd + 1
        if k > 0:
            nth.append(f"SELECT make_date(y, {m}, 1) + cast(({iso} - isodow(make_date(y, {m}, 1)) + 7) % 7 + {7 * (k - 1)} AS integer) AS h FROM yrs")
        else:
            nth.append(f"SELECT cast(last_day(make_date(y, {m}, 1)) AS date) - cast((isodow(last_day(make_date(y, {m}, 1))) - {iso} + 7) % 7 AS integer) AS h FROM yrs")
    return fixed + " UNION ALL " + " UNION ALL ".join(nth)


@register("daily_holidays", _dsql(f""", yrs AS (SELECT unnest(range(cast(year(min(dt)) AS bigint), cast(year(max(dt)) AS bigint) + 1)) AS y FROM d),
hol AS (SELECT DISTINCT cast(h AS date) AS h FROM ({_holiday_sql()}))
SELECT dt, river, off_river, CASE WHEN h IS NULL THEN 0 ELSE 1 END AS holiday FROM d LEFT JOIN hol ON d.dt = hol.h"""))
def daily_holidays(spark, sf):
    return ts.with_holiday_flag(daily(spark, sf), "dt")


# ------------------------------------------------------------ uploads
@register("daily_payload_roundtrip", _dsql("SELECT dt, river FROM d"))
def daily_payload_roundtrip(spark, sf):
    """Daily rows -> yearly CSV payloads (base64) -> parsed rows again."""
    from custos.sources.files import encode_payloads, ingest_payloads
    d = daily(spark, sf).withColumn("year", F.year("dt"))
    pay = encode_payloads(d, "year", ["dt", "river"], "Date,River")
    rows = ingest_payloads(pay, "dt date, river decimal(18,2)")
    return rows.select("dt", "river")


@register("daily_stream_upsert", _dsql("SELECT dt, river, off_river FROM d"))
def daily_stream_upsert(spark, sf):
    """Q2: the daily table written as monthly files, streamed (availableNow) and upserted per date."""
    import os
    from custos.session import ensure_checkpoint_dir
    from custos.streaming.streams import upsert_daily_stream
    import uuid
    base = os.path.join(ensure_checkpoint_dir(spark), f"q2-{uuid.uuid4().hex[:12]}")
    src = os.path.join(base, "src")
    d = daily(spark, sf).withColumn("month", F.date_format("dt", "yyyy-MM"))
    d.write.mode("overwrite").partitionBy("month").parquet(src)
    upsert_daily_stream(spark, src, "dt date, river decimal(18,2), off_river decimal(18,2), month string",
                        os.path.join(base, "target"), os.path.join(base, "ckpt"))
    return spark.read.parquet(os.path.join(base, "target")).drop("_version", "_part", "month")


@register("event_future_weeks", _esql("""
SELECT series_id, cast(s + INTERVAL (7 * i) DAY AS date) AS dt, cast(i + 1 AS integer) AS step FROM (
  SELECT series_id, cast(mx + INTERVAL ((7 - isodow(mx)) % 7) DAY AS date) AS s FROM (
    SELECT series_id, max(dt) AS mx FROM event_daily GROUP BY series_id)), range(0, 4) t(i)"""))
def event_future_weeks(spark, sf):
    return ts.future_dates(fixture(spark, sf, "event_daily"), ["series_id"], "dt", 4, "W")


@register("event_future_days", _esql("""
SELECT series_id, cast(mx + INTERVAL (i + 1) DAY AS date) AS dt, cast(i + 1 AS integer) AS step FROM (
  SELECT series_id, max(dt) AS mx FROM event_daily GROUP BY series_id), range(0, 7) t(i)"""))
def event_future_days(spark, sf):
    return ts.future_dates(fixture(spark, sf, "event_daily"), ["series_id"], "dt", 7, "D")


@register("daily_forecast_summary", _dsql(_FC + """
, fut AS (SELECT cast(d AS date) AS dt FROM (
    SELECT d, row_number() OVER (ORDER BY d) AS rn FROM (
      SELECT unnest(generate_series(mx, mx + INTERVAL 16 DAY, INTERVAL 1 DAY)) AS d FROM (SELECT max(dt) AS mx FROM fc))
    WHERE isodow(d) < 6) WHERE rn > 1 AND rn <= 4),
lastw AS (SELECT cast(sum(river) AS double) / 7.0 AS f FROM (SELECT river FROM fc ORDER BY dt DESC LIMIT 7)),
u AS (SELECT dt, cast(river AS double) AS actual, cast(forecast AS double) AS forecast FROM fc
      UNION ALL SELECT dt, NULL, (SELECT f FROM lastw) FROM fut)
SELECT dt, actual, forecast, forecast - lag(forecast) OVER (ORDER BY dt) AS diff FROM u"""))
def daily_forecast_summary(spark, sf):
    """actual/predicted history plus 3 future business days (mean of the last week), with changes."""
    hist = _daily_fc(spark, sf).select("dt", F.col("river").cast("double").alias("actual"),
                                       F.col("forecast").cast("double").alias("forecast"))
    last7 = ts.last_n(hist, [], "dt", 7).agg((F.sum(F.col("actual")) / 7.0)).scalar()
    fut = ts.future_dates(hist, [], "dt", 3, "B").select("dt", F.lit(None).cast("double").alias("actual"),
                                                          last7.alias("forecast"))
    return ts.forecast_summary(hist, fut, [], "dt", "forecast")
