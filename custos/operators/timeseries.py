"""Window and time-series operators.

Every operator takes ``(df, keys, ts, ...)``.  With series keys the windows
are ``partitionBy(keys).orderBy(ts)`` - one task per group of series.  With
no keys (one long series) the rows are laid out in overlapping blocks
(``layout.halo_frames``) so the same window runs in parallel; helper columns
are dropped before returning.

Recursive filters (exponentially weighted means) are evaluated as a fold over
the last K rows, K chosen so the dropped weight (1-a)^K is below 1e-16; the
fold runs in the JVM (``aggregate`` over ``collect_list`` of a bounded frame).
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custos.operators.layout import halo_frames


class SeriesFrame:
    """Window plumbing shared by all operators.

    ``layout="auto"`` (default) measures the longest series with one small
    aggregate: when every series fits in one block of ``block`` rows, the
    plain ``partitionBy(keys).orderBy(ts)`` window is used (one task per
    series, each bounded by ``block`` rows); otherwise series are cut into
    blocks with a halo, so neither one long series nor one hot key lands on a
    single task.  ``"halo"`` and ``"partition"`` force a layout.
    """

    def __init__(self, df: DataFrame, keys: list[str], ts: str, halo: int = 0, lead: int = 0,
                 block: int = 4096, layout: str = "auto"):
        self.keys, self.ts = list(keys), ts
        block = max(block, 2 * (halo + lead) + 2)
        if layout == "auto":
            longest = (df.groupBy(*self.keys).count().agg(F.max("count")).first()[0] if self.keys
                       else df.count()) or 0
            layout = "partition" if longest <= block else "halo"
        if layout == "partition":
            self.halo_mode = False
            self.w = Window.partitionBy(*self.keys).orderBy(ts)
            self.df = df.withColumn("idx", (F.row_number().over(self.w) - 1).cast("bigint"))
        else:
            self.halo_mode = True
            self.df, wkeys = halo_frames(df, ts, halo, block, lead=lead, partition_cols=self.keys)
            self.w = Window.partitionBy(*wkeys).orderBy("idx")

    def rows(self, lo, hi) -> Window:
        return self.w.rowsBetween(lo, hi)

    def finish(self, df: DataFrame, keep_idx: bool = False) -> DataFrame:
        if self.halo_mode:
            df = df.where("_own").drop("_own", "_blk")
        return df if keep_idx else df.drop("idx")


def _num(c: str) -> Column:
    return F.col(c)


# ------------------------------------------------------------------ rolling
def rolling(df: DataFrame, keys: list[str], ts: str, col: str, sizes=(5,), fn: str = "mean") -> DataFrame:
    """Rolling mean or sample sd, null until the window is full.

    Sums run in the input type: DECIMAL inputs give exact sums, so the mean is
    ``double(sum)/n`` and the variance ``(n sum x^2 - (sum x)^2) / (n (n-1))``
    are reproducible to the last bit.
    """
    sf = SeriesFrame(df, keys, ts, halo=max(sizes) - 1)
    out = sf.df
    x = _num(col)
    for n in sizes:
        w = sf.rows(-(n - 1), 0)
        cnt = F.count(x).over(w)
        s1 = F.sum(x).over(w)
        if fn == "mean":
            val = s1.cast("double") / F.lit(float(n))
        elif fn == "sd":
            s2 = F.sum(x * x).over(w)
            val = F.sqrt(F.greatest((s2 * n - s1 * s1).cast("double"), F.lit(0.0)) / float(n * (n - 1)))
        else:
            raise ValueError(fn)
        out = out.withColumn(f"{fn}{n}_{col}", F.when(cnt == n, val))
    return sf.finish(out)


# ---------------------------------------------------------------------- ewm
def ewm_window(alpha: float, eps: float = 1e-16) -> int:
    return max(1, int(math.ceil(math.log(eps) / math.log(1.0 - alpha)))) if alpha < 1 else 1


def _ewm_expr(vals: Column, first_is_origin: Column, alpha: float, adjust: bool) -> Column:
    """Fold of ``vals`` (NaN: no value); a row without a value decays the weights and keeps the mean."""
    w = 1.0 - alpha
    if adjust:
        acc = F.aggregate(vals, F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den")),
                          lambda a, x: F.struct(F.when(F.isnan(x), a["num"] * w).otherwise(a["num"] * w + x).alias("num"),
                                                F.when(F.isnan(x), a["den"] * w).otherwise(a["den"] * w + 1.0).alias("den")))
        return F.when(acc["den"] > 0, acc["num"] / acc["den"])

    def step(a, x):
        y, g = a["y"], a["g"] * w  # g: weight that the mean has kept since the last value
        near = y * w + x * alpha
        far = (g * y + x * alpha) / (g + alpha)
        value = F.when(y.isNull(), x).when(a["g"] == 1.0, near).otherwise(far)
        return F.struct(F.when(F.isnan(x), y).otherwise(value).alias("y"),
                        F.when(~F.isnan(x), F.lit(1.0)).otherwise(g).alias("g"))
    start = F.struct(F.when(~first_is_origin, F.lit(0.0)).alias("y"), F.lit(1.0).alias("g"))
    return F.when(F.exists(vals, lambda x: ~F.isnan(x)), F.aggregate(vals, start, step)["y"])


def ewm_many(df: DataFrame, keys: list[str], ts: str, specs, pre=None) -> DataFrame:
    """Several exponentially weighted means on one window layout.

    ``specs``: list of (column, alpha, adjust, output name).  ``pre`` may add
    window-derived input columns (given the SeriesFrame) before the folds.
    """
    k = max(ewm_window(a) for _, a, _, _ in specs)
    sf = SeriesFrame(df, keys, ts, halo=k + 1)
    base = sf.df if pre is None else pre(sf)
    origin = F.col("idx") < k  # the window still contains the series' first row
    out = base
    for col, alpha, adjust, name in specs:
        kk = ewm_window(alpha)
        vals = F.collect_list(F.coalesce(F.col(col).cast("double"), F.lit(float("nan")))).over(sf.rows(-(kk - 1), 0))
        out = out.withColumn(f"_v_{name}", vals)
    for col, alpha, adjust, name in specs:
        kk = ewm_window(alpha)
        out = out.withColumn(name, _ewm_expr(F.col(f"_v_{name}"), F.col("idx") < kk, alpha, adjust))
    out = out.drop(*[f"_v_{name}" for *_, name in specs])
    del origin
    return sf.finish(out)


def ewm(df: DataFrame, keys: list[str], ts: str, col: str, alpha: float, adjust: bool = True,
        out: str | None = None) -> DataFrame:
    """Exponentially weighted mean (pandas ``adjust`` semantics).

    alpha = 1/(1+com) = 2/(span+1).  Weights decay by position, as in
    pandas with ``ignore_na=False``: a null (or NaN) row keeps the mean and lowers the weight
    of what came before it; rows before the first value are null.  Rows further
    back than the frame of K rows are left out: their share is below
    1e-16 / (1-alpha)^g after a gap of g nulls, and after K nulls on end the
    mean is null.
    """
    return ewm_many(df, keys, ts, [(col, alpha, adjust, out or f"ewm_{col}")])


def macd(df: DataFrame, keys: list[str], ts: str, col: str, fast: int = 12, slow: int = 26) -> DataFrame:
    """MACD = unadjusted ewm(span fast) - ewm(span slow), both on one layout."""
    out = ewm_many(df, keys, ts, [(col, 2.0 / (fast + 1), False, f"ema{fast}_{col}"),
                                   (col, 2.0 / (slow + 1), False, f"ema{slow}_{col}")])
    return out.withColumn(f"macd_{col}", F.col(f"ema{fast}_{col}") - F.col(f"ema{slow}_{col}"))


def rsi(df: DataFrame, keys: list[str], ts: str, col: str, n: int = 14, kind: str = "standard") -> DataFrame:
    """Relative strength index from adjusted ewm(span n) of up and down moves.

    ``kind="standard"`` uses |down|; ``kind="reference"`` keeps down moves
    negative as the reference does (X13), which leaves [0, 100].  The first
    row has no move, so the filter starts at the second row.  Moves and both filters share one window layout.
    """
    def moves(sf):
        d = sf.df.withColumn("_delta", F.col(col) - F.lag(col, 1).over(sf.w))
        up = F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.lit(0)).cast("double")
        dn = F.when(F.col("_delta") < 0, F.col("_delta")).otherwise(F.lit(0)).cast("double")
        if kind == "standard":
            dn = F.abs(dn)
        has = F.col("_delta").isNotNull()
        return d.withColumn("_up", F.when(has, up)).withColumn("_dn", F.when(has, dn))
    a = 2.0 / (n + 1)
    e = ewm_many(df, keys, ts, [("_up", a, True, "_eu"), ("_dn", a, True, "_ed")], pre=moves)
    return (e.withColumn(f"rsi_{col}", 100.0 - 100.0 / (1.0 + F.try_divide("_eu", "_ed")))
             .drop("_delta", "_up", "_dn", "_eu", "_ed"))


# ------------------------------------------------------------- lags & diffs
def lags(df: DataFrame, keys: list[str], ts: str, cols: list[str], ks=(1, 2),
         diff: bool = True, direction: bool = True) -> DataFrame:
    """Lags, first difference and the 0/1 direction target (first row 0)."""
    sf = SeriesFrame(df, keys, ts, halo=max(ks))
    out = sf.df
    for c in cols:
        for k in ks:
            out = out.withColumn(f"{c}_lag{k}", F.lag(c, k).over(sf.w))
        if diff:
            out = out.withColumn(f"{c}_diff", F.col(c) - F.lag(c, 1).over(sf.w))
        if direction:
            out = out.withColumn(f"{c}_up", F.coalesce((F.col(c) - F.lag(c, 1).over(sf.w) > 0).cast("int"), F.lit(0)))
    return sf.finish(out)


def interactions(df: DataFrame, keys: list[str], ts: str, series: list[str], multipliers: list[str]) -> DataFrame:
    """lag(m_i * x, 1) with 0 (not null) in the first row."""
    sf = SeriesFrame(df, keys, ts, halo=1)
    out = sf.df
    for x in series:
        for m in multipliers:
            out = out.withColumn(f"{m}_x_{x}", F.lag(F.col(m) * F.col(x), 1, 0).over(sf.w))
    return sf.finish(out)


def design_matrix(df: DataFrame, keys: list[str], ts: str, lagged: dict[str, int], known: list[str]) -> DataFrame:
    """Lag columns per variable plus known regressors, first max-lag rows trimmed."""
    max_lag = max(lagged.values())
    sf = SeriesFrame(df, keys, ts, halo=max_lag)
    out = sf.df
    cols = []
    for c, L in lagged.items():
        for k in range(1, L + 1):
            out = out.withColumn(f"{c}_l{k}", F.lag(c, k).over(sf.w))
            cols.append(f"{c}_l{k}")
    out = sf.finish(out, keep_idx=True).where(F.col("idx") >= max_lag)
    return out.select(*keys, ts, *known, *cols)


def lookback(df: DataFrame, keys: list[str], ts: str, features: list[str], target: str, n: int = 7) -> DataFrame:
    """Supervised frame - the previous n rows of the features and the current target.

    Rows without a full history are dropped, and so is the last row of each
    series (the reference stops one short).
    """
    sf = SeriesFrame(df, keys, ts, halo=n, lead=1)
    feats = F.array(*[F.col(f).cast("double") for f in features])
    hist = F.collect_list(feats).over(sf.rows(-n, -1))
    nxt = F.lead(F.col(ts), 1).over(sf.w)
    out = sf.df.withColumn("window", hist).withColumn("_next", nxt)
    out = sf.finish(out).where((F.size("window") == n) & F.col("_next").isNotNull())
    return out.select(*keys, ts, "window", F.col(target).cast("double").alias("target"))


# ---------------------------------------------------------------- ACF etc.
def acf(df: DataFrame, keys: list[str], ts: str, col: str, nlags: int = 20, digits: int = 6) -> DataFrame:
    """Sample autocorrelation r_k, k=0..nlags, with the +/-1.96/sqrt(n) band."""
    x = F.col(col).cast("double")
    means = df.groupBy(*keys).agg(F.avg(x).alias("_m"), F.count(x).alias("_n")) if keys else None
    base = df.join(means, keys) if keys else df.withColumn("_m", df.agg(F.avg(x)).scalar()) \
                                               .withColumn("_n", df.agg(F.count(x)).scalar())
    base = base.withColumn("_d", x - F.col("_m"))
    sf = SeriesFrame(base, keys, ts, halo=nlags)
    out = sf.df
    for k in range(1, nlags + 1):
        out = out.withColumn(f"_p{k}", F.col("_d") * F.lag("_d", k).over(sf.w))
    out = sf.finish(out)
    sums = out.groupBy(*keys, "_n").agg(F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
                                        *[F.sum(f"_p{k}").alias(f"_s{k}") for k in range(1, nlags + 1)])
    stack = ", ".join(f"{k}, `_s{k}`" for k in range(0, nlags + 1))
    long = sums.selectExpr(*keys, "_n", "_s0 AS _den", f"stack({nlags + 1}, {stack}) AS (lag, _num)")
    return long.select(*keys, F.col("lag").cast("int").alias("lag"),
                       F.round(F.col("_num") / F.col("_den"), digits).alias("acf"),
                       F.round(1.96 / F.sqrt(F.col("_n").cast("double")), digits).alias("band"))


def ljung_box(acf_df: DataFrame, n_obs: Column | int, h: int, fitted: int = 0,
              keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Q = n(n+2) sum_{k=1..h} r_k^2/(n-k), df = h - fitted parameters."""
    keys = keys or []
    n = F.lit(n_obs) if isinstance(n_obs, int) else n_obs
    r = acf_df.where((F.col("lag") >= 1) & (F.col("lag") <= h)).withColumn("_n", n)
    return (r.groupBy(*keys).agg(F.sum(F.col("acf") * F.col("acf") / (F.col("_n") - F.col("lag"))).alias("_s"),
                                 F.first("_n").alias("_n"))
             .select(*keys, F.round(F.col("_n") * (F.col("_n") + 2) * F.col("_s"), digits).alias("q"),
                     F.lit(h - fitted).alias("df")))


def decompose(df: DataFrame, keys: list[str], ts: str, col: str, period: int = 12, digits: int = 6) -> DataFrame:
    """W16 (re-aimed STL): centred moving-average trend and per-phase seasonal means.

    Even periods use the 2 x period centred average.  The seasonal component
    is the mean detrended value per phase, centred to sum to zero; the
    remainder is value - trend - seasonal.
    """
    half = period // 2
    sf = SeriesFrame(df, keys, ts, halo=half, lead=half)
    x = F.col(col).cast("double")
    if period % 2 == 0:
        w_full = sf.rows(-half, half)
        s = F.sum(x).over(w_full) - 0.5 * F.first(x).over(w_full) - 0.5 * F.last(x).over(w_full)
        cnt = F.count(x).over(w_full)
        trend = F.when(cnt == period + 1, s / period)
    else:
        w_full = sf.rows(-half, half)
        trend = F.when(F.count(x).over(w_full) == period, F.avg(x).over(w_full))
    out = sf.finish(sf.df.withColumn("trend", trend), keep_idx=True)
    out = out.withColumn("phase", (F.col("idx") % period).cast("int")).withColumn("_det", x - F.col("trend"))
    ph = out.groupBy(*keys, "phase").agg(F.avg("_det").alias("_sm"))
    centre = ph.groupBy(*keys).agg(F.avg("_sm").alias("_c"))
    ph = (ph.join(centre, keys) if keys else ph.withColumn("_c", centre.select("_c").scalar()))
    ph = ph.select(*keys, "phase", (F.col("_sm") - F.col("_c")).alias("seasonal"))
    res = out.join(ph, [*keys, "phase"], "left")
    return res.select(*keys, ts, F.round("trend", digits).alias("trend"), F.round("seasonal", digits).alias("seasonal"),
                      F.round(x - F.col("trend") - F.col("seasonal"), digits).alias("remainder"))


# ------------------------------------------------------------ date helpers
def future_dates(df: DataFrame, keys: list[str], ts: str, h: int = 3, freq: str = "B") -> DataFrame:
    """The next h dates after each series' last date.

    ``B``: business days - h+1 business days starting at the last date (a
    weekend rolls forward to Monday), the first dropped.  ``W``: h Sundays
    starting at the first Sunday on or after the last date.  ``D``: the
    following h days.
    """
    last = df.groupBy(*keys).agg(F.max(F.col(ts).cast("date")).alias("_last"))
    if freq == "B":
        cand = last.select(*keys, F.explode(F.sequence(F.col("_last"), F.date_add("_last", 3 * (h + 1) + 4)))
                           .alias("d"), "_last")
        cand = cand.where(~F.dayofweek("d").isin(1, 7))
        w = Window.partitionBy(*keys).orderBy("d")
        cand = cand.withColumn("_rn", F.row_number().over(w)).where((F.col("_rn") > 1) & (F.col("_rn") <= h + 1))
        return cand.select(*keys, F.col("d").alias(ts), (F.col("_rn") - 1).cast("int").alias("step"))
    if freq == "W":
        # Sunday-anchored weeks starting at the last date when it is a Sunday
        start = F.date_add(F.col("_last"), ((F.lit(8) - F.dayofweek("_last")) % 7).cast("int"))
        return last.select(*keys, F.posexplode(F.sequence(start, F.date_add(start, 7 * (h - 1)), F.expr("INTERVAL 7 DAYS")))
                           .alias("step", ts)).withColumn("step", (F.col("step") + 1).cast("int"))
    return last.select(*keys, F.posexplode(F.sequence(F.date_add("_last", 1), F.date_add("_last", h)))
                       .alias("step", ts)).withColumn("step", (F.col("step") + 1).cast("int"))


def last_n(df: DataFrame, keys: list[str], ts: str, n: int) -> DataFrame:
    """The last n rows of each series (global top-k when there are no keys)."""
    if not keys:
        return df.orderBy(F.desc(ts)).limit(n)
    w = Window.partitionBy(*keys).orderBy(F.desc(ts))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


# US federal holidays (rule: month, weekday 0=Mon, n-th; n=-1 last).
FIXED_HOLIDAYS = [("New Year's Day", 1, 1), ("Independence Day", 7, 4), ("Veterans Day", 11, 11),
                  ("Christmas Day", 12, 25)]
NTH_WEEKDAY_HOLIDAYS = [("Martin Luther King Jr. Day", 1, 0, 3), ("Presidents Day", 2, 0, 3),
                        ("Memorial Day", 5, 0, -1), ("Labor Day", 9, 0, 1), ("Columbus Day", 10, 0, 2),
                        ("Thanksgiving Day", 11, 3, 4)]


def holiday_dimension(spark, first_year: Column | int, last_year: Column | int) -> DataFrame:
    """Federal holiday dates (fixed dates moved to the nearest weekday) for a year range.

    The table has 10 rows per year, so it is bounded by the calendar span.
    """
    fy = F.lit(first_year) if isinstance(first_year, int) else first_year
    ly = F.lit(last_year) if isinstance(last_year, int) else last_year
    years = spark.range(1).select(F.explode(F.sequence(fy, ly)).alias("year"))
    rows = []
    for name, m, d in FIXED_HOLIDAYS:
        day = F.make_date("year", F.lit(m), F.lit(d))
        dow = F.dayofweek(day)  # 1=Sun, 7=Sat
        obs = F.when(dow == 7, F.date_sub(day, 1)).when(dow == 1, F.date_add(day, 1)).otherwise(day)
        rows.append(years.select(F.lit(name).alias("holiday"), obs.alias("date")))
    for name, m, wd, nth in NTH_WEEKDAY_HOLIDAYS:
        spark_dow = (wd + 1) % 7 + 1  # Mon=2 ... Sun=1
        if nth > 0:
            first = F.make_date("year", F.lit(m), F.lit(1))
            off = (F.lit(spark_dow) - F.dayofweek(first) + 7) % 7
            day = F.date_add(first, (off + 7 * (nth - 1)).cast("int"))
        else:
            last = F.last_day(F.make_date("year", F.lit(m), F.lit(1)))
            off = (F.dayofweek(last) - F.lit(spark_dow) + 7) % 7
            day = F.date_sub(last, off.cast("int"))
        rows.append(years.select(F.lit(name).alias("holiday"), day.alias("date")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def with_holiday_flag(df: DataFrame, ts: str) -> DataFrame:
    """0/1 holiday indicator joined to each date (holiday table broadcast: 10 rows / year)."""
    d = F.col(ts).cast("date")
    bounds = df.agg(F.min(F.year(d)).alias("a"), F.max(F.year(d)).alias("b"))
    hol = holiday_dimension(df.sparkSession, bounds.select("a").scalar(), bounds.select("b").scalar())
    hol = hol.groupBy("date").agg(F.lit(1).alias("holiday"))
    return (df.join(F.broadcast(hol), d == F.col("date"), "left").drop("date")
              .withColumn("holiday", F.coalesce("holiday", F.lit(0))))


# ---------------------------------------------------------------- forecasts
def direction_confusion(df: DataFrame, keys: list[str], ts: str, actual: str, pred: str) -> DataFrame:
    """Counts of (actual up?, predicted up?) over first differences; rate over n rows."""
    sf = SeriesFrame(df, keys, ts, halo=1)
    out = sf.df.withColumn("_da", F.col(actual) - F.lag(actual, 1).over(sf.w)) \
               .withColumn("_dp", F.col(pred) - F.lag(pred, 1).over(sf.w))
    out = sf.finish(out).where(F.col("_da").isNotNull() & F.col("_dp").isNotNull())
    n = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    g = out.groupBy(*keys, (F.col("_da") > 0).cast("int").alias("actual_up"),
                    (F.col("_dp") > 0).cast("int").alias("pred_up")).agg(F.count("*").alias("count"))
    g = g.join(n, keys) if keys else g.withColumn("n_rows", n.select("n_rows").scalar())
    return g.withColumn("rate", F.col("count") / F.col("n_rows"))


def direction_auc(conf: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AUC of a binary call = (TPR + TNR)/2, confusion accuracy and their max."""
    keys = keys or []
    s = conf.groupBy(*keys).agg(
        F.sum(F.when((F.col("actual_up") == 1) & (F.col("pred_up") == 1), F.col("count")).otherwise(0)).alias("tp"),
        F.sum(F.when((F.col("actual_up") == 1) & (F.col("pred_up") == 0), F.col("count")).otherwise(0)).alias("fn"),
        F.sum(F.when((F.col("actual_up") == 0) & (F.col("pred_up") == 0), F.col("count")).otherwise(0)).alias("tn"),
        F.sum(F.when((F.col("actual_up") == 0) & (F.col("pred_up") == 1), F.col("count")).otherwise(0)).alias("fp"))
    tpr = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    tnr = F.try_divide(F.col("tn").cast("double"), (F.col("tn") + F.col("fp")).cast("double"))
    acc = (F.col("tp") + F.col("tn")).cast("double") / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    return s.select(*keys, ((tpr + tnr) / 2.0).alias("auc"), acc.alias("accuracy"),
                    F.greatest((tpr + tnr) / 2.0, acc).alias("model_accuracy"))


def call_right(df: DataFrame, keys: list[str], ts: str, actual: str, pred: str) -> DataFrame:
    """W20: 'yes' when predicted and actual change share a sign; zero or missing -> 'no'."""
    sf = SeriesFrame(df, keys, ts, halo=1)
    da = F.col(actual) - F.lag(actual, 1).over(sf.w)
    dp = F.col(pred) - F.lag(actual, 1).over(sf.w)
    flag = F.when((F.signum(da) == F.signum(dp)) & (F.signum(da) != 0), F.lit("yes")).otherwise(F.lit("no"))
    return sf.finish(sf.df.withColumn("correct", flag))


def forecast_summary(hist: DataFrame, future: DataFrame, keys: list[str], ts: str, value: str = "forecast") -> DataFrame:
    """actual/predicted rows followed by future rows, with the change to the previous forecast."""
    u = hist.unionByName(future, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(ts)
    if not keys:
        sf = SeriesFrame(u, keys, ts, halo=1)
        return sf.finish(sf.df.withColumn("diff", F.col(value) - F.lag(value, 1).over(sf.w)))
    return u.withColumn("diff", F.col(value) - F.lag(value, 1).over(w))


def errors(df: DataFrame, keys: list[str], ts: str, actual: str, pred: str, digits: int = 6) -> DataFrame:
    """ME, MAE, MAD, MSE, RMSE, MPE, MAPE, MASE and ACF1 of the errors.

    Errors keep the input type: with DECIMAL actuals and forecasts the mean
    error, absolute error and squared error are exact decimal averages, so
    they do not depend on summation order.  MASE scales MAE by the in-sample
    mean absolute first difference of the actuals.
    """
    sf = SeriesFrame(df, keys, ts, halo=1)
    y, f = F.col(actual), F.col(pred)
    out = (sf.df.withColumn("_e", y - f)
                .withColumn("_naive", F.abs(y - F.lag(y, 1).over(sf.w)))
                .withColumn("_e_lag", F.lag(y - f, 1).over(sf.w)))
    out = sf.finish(out)
    scale = out.groupBy(*keys).agg(F.avg("_naive").alias("_scale"))
    out = out.where(F.col("_e").isNotNull())
    ed = F.col("_e").cast("double")
    m = out.groupBy(*keys).agg(F.avg(ed).alias("_me_d"))
    out = out.join(m, keys) if keys else out.withColumn("_me_d", m.select("_me_d").scalar())
    yd = y.cast("double")
    g = out.groupBy(*keys).agg(
        F.avg("_e").alias("_me"), F.avg(F.abs("_e")).alias("_mae"), F.avg(F.col("_e") * F.col("_e")).alias("_mse"),
        F.avg(F.when(yd != 0, ed / yd)).alias("_mpe"), F.avg(F.when(yd != 0, F.abs(ed / yd))).alias("_mape"),
        F.sum((ed - F.col("_me_d")) * (F.col("_e_lag").cast("double") - F.col("_me_d"))).alias("_a1n"),
        F.sum((ed - F.col("_me_d")) * (ed - F.col("_me_d"))).alias("_a1d"))
    g = g.join(scale, keys) if keys else g.withColumn("_scale", scale.select("_scale").scalar())
    r = lambda c: F.round(c, digits)
    mae = F.col("_mae").cast("double")
    return g.select(*keys, F.col("_me").cast("double").alias("me"), mae.alias("mae"), mae.alias("mad"),
                    F.col("_mse").cast("double").alias("mse"), F.sqrt(F.col("_mse").cast("double")).alias("rmse"),
                    r(F.col("_mpe") * 100).alias("mpe"), r(F.col("_mape") * 100).alias("mape"),
                    F.try_divide(mae, F.col("_scale").cast("double")).alias("mase"),
                    r(F.try_divide(F.col("_a1n"), F.col("_a1d"))).alias("acf1"))


def cumulative_abs_error(df: DataFrame, keys: list[str], ts: str, actual: str, pred: str) -> DataFrame:
    """Running sum of |actual - predicted| per series."""
    from custos.operators.layout import prefix_sums
    # DECIMAL inputs sum exactly; rows without a forecast add nothing
    d = df.withColumn("_ae", F.coalesce(F.abs(F.col(actual) - F.col(pred)), F.lit(0)))
    return prefix_sums(d, [ts], ["_ae"], partition_cols=keys).withColumnRenamed("cum__ae", "cum_abs_error").drop("_ae")


def xcorr_lag(df: DataFrame, keys: list[str], ts: str, y: str, x: str, max_lag: int = 12, digits: int = 6) -> DataFrame:
    """corr(y_t, x_{t-k}) for k = 0..max_lag and the lag with the largest |corr|."""
    sf = SeriesFrame(df, keys, ts, halo=max_lag)
    out = sf.df
    for k in range(0, max_lag + 1):
        out = out.withColumn(f"_x{k}", F.lag(F.col(x).cast("double"), k).over(sf.w) if k else F.col(x).cast("double"))
    out = sf.finish(out)
    g = out.groupBy(*keys).agg(*[F.corr(F.col(y).cast("double"), f"_x{k}").alias(f"_c{k}") for k in range(max_lag + 1)])
    stack = ", ".join(f"{k}, `_c{k}`" for k in range(max_lag + 1))
    long = g.selectExpr(*keys, f"stack({max_lag + 1}, {stack}) AS (lag, corr)")
    long = long.withColumn("corr", F.round("corr", digits))
    best = long.groupBy(*keys).agg(F.max_by("lag", F.struct(F.abs("corr"), -F.col("lag"))).alias("best_lag"))
    return (long.join(best, keys) if keys else long.withColumn("best_lag", best.select("best_lag").scalar()))


_ = dt  # datetime kept for callers building literal dates


# ------------------------------------------------------ PACF / ADF
def _standardised(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Adds ``_z``, the column centred and scaled per series, and its deviation ``_sd``.

    Lag regressions with a constant give the same lag coefficients and t-ratios
    on ``_z``, and their moment sums keep all digits at any level of the series.
    """
    x = F.col(col).cast("double")
    aggs = F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd")).alias("_s")
    out = df.join(df.groupBy(*keys).agg(aggs), keys) if keys else df.withColumn("_s", df.agg(aggs).scalar())
    sd = F.when(F.col("_s")["sd"] > 0, F.col("_s")["sd"]).otherwise(1.0)
    return out.withColumn("_z", (x - F.col("_s")["mean"]) / sd).withColumn("_sd", sd).drop("_s")


def _lag_moments(df: DataFrame, keys: list[str], ts: str, cols_fn, k_max: int, start: int):
    """Sums of all pairwise products of the columns built by ``cols_fn`` over rows idx >= start."""
    sf = SeriesFrame(df, keys, ts, halo=k_max + 1)
    out, names = cols_fn(sf)
    out = sf.finish(out, keep_idx=True).where(F.col("idx") >= start)
    aggs = [F.count("*").alias("n"), F.max("_sd").alias("sd")]
    for i in range(len(names)):
        for j in range(i, len(names)):
            aggs.append(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"m_{i}_{j}"))
    return (out.groupBy(*keys).agg(*aggs) if keys else out.agg(*aggs)), names


def _moment_matrix(row, size):
    import numpy as np
    M = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            M[i, j] = M[j, i] = row[f"m_{i}_{j}"]
    return M


def pacf(df: DataFrame, keys: list[str], ts: str, col: str, nlags: int = 20) -> DataFrame:
    """Partial autocorrelation by OLS - last coefficient of x_t on 1, x_{t-1..t-k}.

    One aggregate gives the moment matrix of (1, x_t, ..., x_{t-K}) over the
    common sample (rows with K lags); each k is a small solve on it.
    """
    import numpy as np

    def cols(sf):
        out = sf.df.withColumn("_c1", F.lit(1.0)).withColumn("_x0", F.col("_z"))
        for k in range(1, nlags + 1):
            out = out.withColumn(f"_x{k}", F.lag("_z", k).over(sf.w))
        return out, ["_c1"] + [f"_x{k}" for k in range(nlags + 1)]
    mom, names = _lag_moments(_standardised(df, keys, col), keys, ts, cols, nlags, nlags)
    size = len(names)
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = (key_schema + ", " if keys else "") + "lag int, pacf double"

    def solve(pdf):
        rows = []
        for _, r in pdf.iterrows():
            M = _moment_matrix(r, size)
            for k in range(1, nlags + 1):
                idx = [0] + list(range(2, 2 + k))      # 1, x_{t-1..t-k}
                XX = M[np.ix_(idx, idx)]
                Xy = M[idx, 1]
                beta = np.linalg.lstsq(XX, Xy, rcond=None)[0]
                rows.append({**{kk: r[kk] for kk in keys}, "lag": k, "pacf": float(beta[-1])})
        return pd.DataFrame(rows, columns=[*keys, "lag", "pacf"])
    import pandas as pd
    if keys:
        return mom.groupBy(*keys).applyInPandas(solve, schema)
    return mom.mapInPandas(lambda it: (solve(p) for p in it), schema)


def adf(df: DataFrame, keys: list[str], ts: str, col: str, max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller (constant), lag order by AIC on a common sample.

    Regression: dx_t on 1, x_{t-1}, dx_{t-1..t-p}.  The statistic is the
    t-ratio of x_{t-1}; critical values follow MacKinnon (2010), constant only.
    """
    import math
    import numpy as np
    import pandas as pd
    if max_lag is None:  # Schwert rule on the longest series
        longest = (df.groupBy(*keys).count().agg(F.max("count")).first()[0] if keys
                   else df.agg(F.count(col)).first()[0])
        max_lag = int(math.ceil(12 * (float(longest) / 100.0) ** 0.25))

    def cols(sf):
        x = F.col("_z")
        out = sf.df.withColumn("_dx", x - F.lag(x, 1).over(sf.w)).withColumn("_c1", F.lit(1.0)) \
                   .withColumn("_xl", F.lag(x, 1).over(sf.w))
        for k in range(1, max_lag + 1):
            out = out.withColumn(f"_d{k}", F.lag("_dx", k).over(sf.w))
        return out, ["_dx", "_c1", "_xl"] + [f"_d{k}" for k in range(1, max_lag + 1)]
    mom, names = _lag_moments(_standardised(df, keys, col), keys, ts, cols, max_lag + 1, max_lag + 1)
    size = len(names)
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = (key_schema + ", " if keys else "") + \
        "lags int, adf_stat double, nobs long, aic double, crit_1 double, crit_5 double, crit_10 double"

    def solve(pdf):
        rows = []
        for _, r in pdf.iterrows():
            M = _moment_matrix(r, size)
            n = float(r["n"])
            best = None
            for p in range(0, max_lag + 1):
                idx = [1, 2] + list(range(3, 3 + p))
                XX, Xy, yy = M[np.ix_(idx, idx)], M[idx, 0], M[0, 0]
                beta = np.linalg.lstsq(XX, Xy, rcond=None)[0]
                rss = max(float(yy - 2 * beta @ Xy + beta @ XX @ beta), 1e-300)
                aic = n * math.log(rss / n) + 2 * len(idx)
                if best is None or aic < best[0]:
                    s2 = rss / (n - len(idx))
                    cov = s2 * np.linalg.pinv(XX)
                    best = (aic, p, float(beta[1] / math.sqrt(cov[1, 1])))
            crit = lambda a, b, c, d: a + b / n + c / n ** 2 + d / n ** 3
            rows.append({**{kk: r[kk] for kk in keys}, "lags": best[1], "adf_stat": best[2], "nobs": int(n),
                         "aic": best[0] + 2 * n * math.log(r["sd"]), "crit_1": crit(-3.43035, -6.5393, -16.786, -79.433),
                         "crit_5": crit(-2.86154, -2.8903, -4.234, -40.040),
                         "crit_10": crit(-2.56677, -1.5384, -2.809, 0.0)})
        return pd.DataFrame(rows, columns=[*keys, "lags", "adf_stat", "nobs", "aic", "crit_1", "crit_5", "crit_10"])
    if keys:
        return mom.groupBy(*keys).applyInPandas(solve, schema)
    return mom.mapInPandas(lambda it: (solve(p) for p in it), schema)


def scenario_paths(last: DataFrame, value: str, levels=(0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30), horizon: int = 12,
                   out: str = "value") -> DataFrame:
    """Per row of ``last``, its value (scenario 0) and fixed levels, each repeated over the horizon."""
    keys = [c for c in last.columns if c != value]
    grid = F.array(F.col(value).cast("double"), *[F.lit(float(v)) for v in levels])
    return (last.select(*keys, F.posexplode(grid).alias("scenario", out))
                .select(*keys, "scenario", out, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")))


def scenario_grid(last_value: Column, levels=(0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30), horizon: int = 12,
                  spark=None) -> DataFrame:
    """``scenario_paths`` of a single value."""
    return scenario_paths(spark.range(1).select(last_value.alias("last")), "last", levels, horizon)
