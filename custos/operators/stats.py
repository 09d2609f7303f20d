"""Relational statistics and evaluation tables.

Everything here is an aggregate or a partitioned window; the only global
orders (ROC curve, ranks) go through ``layout.prefix_sums`` so they never sit
on one task.  Exact quantiles (``exact_quantiles``, ``describe``) pick order
statistics by rank from per-value counts, so no task ever holds all values of
a group and there is one path for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custos.operators.layout import prefix_sums, rank_ranges


# ------------------------------------------------------------ exact quantiles
def _at_positions(probs, names) -> list[Column]:
    """Aggregates over rank ranges: the two order statistics around position p(n-1) and the fraction between them."""
    aggs = []
    for p, name in zip(probs, names):
        pos = (F.col("_n") - 1) * float(p)
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_x"))).alias(f"_{name}_{side}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_{name}_f"))
    return aggs


def _interpolated(name: str) -> Column:
    lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
    return (lo + (hi - lo) * F.col(f"_{name}_f")).alias(name)


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs, names=None,
                    max_buffer: int | None = None) -> DataFrame:
    """Exact interpolated quantiles (position p(n-1), linear between neighbours) per group.

    Rows are reduced to (group, value, count), every value's rank range comes
    from sums over value buckets (``layout.rank_ranges``), and the two order
    statistics around each position are picked by their rank, so no task or
    buffer holds all values of a group, whatever its size.  One output row per
    group with a column per probability; null for a group without values.
    ``max_buffer`` is kept for callers and has no effect.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    counts = df.select(*keys, F.col(col).cast("double").alias("_x")).groupBy(*keys, "_x").agg(F.count("_x").alias("_c"))
    bounds = value_bounds(df, [col])[col]
    ranks = rank_ranges(counts, "_x", "_c", keys, _bucket(F.lit(bounds) if bounds else None, F.col("_x")))
    return ranks.groupBy(*keys).agg(*_at_positions(probs, names)).select(*keys, *[_interpolated(nm) for nm in names])


def _buckets(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bound_probs(df: DataFrame) -> list[float]:
    return [i / _buckets(df) for i in range(1, _buckets(df))]


def _bounds_of(values) -> list[float]:
    return sorted({float(v) for v in values or () if v is not None and v == v})


def value_bounds(df: DataFrame, cols: list[str]) -> dict[str, list[float]]:
    """Cut points that deal the values of each column into as many ranges as there are shuffle partitions (one job)."""
    probs = F.array(*[F.lit(p) for p in _bound_probs(df)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 8 * _buckets(df)).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c: _bounds_of(row[f"b{i}"]) for i, c in enumerate(cols)}


def _bucket(bounds: Column | None, x: Column) -> Column:
    """Count of cut points at or below ``x`` (a value never straddles two buckets)."""
    return F.lit(0) if bounds is None else F.size(F.filter(bounds, lambda b: b <= x))


def _per_column(values: dict[str, Column]) -> Column:
    """The entry of ``values`` for the column that ``column_name`` names."""
    return F.element_at(F.create_map(*(v for c, e in values.items() for v in (F.lit(c), e))), F.col("column_name"))


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<double>")


def _value_counts_of(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, _x, _c): the non-null values of all columns with their counts, from one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x")) for c in cols])
    return (df.select(F.explode(cells).alias("_cell")).select("_cell.*").where(F.col("_x").isNotNull())
              .groupBy("column_name", "_x").agg(F.count("*").alias("_c")))


def _column_summary(df: DataFrame, cols: list[str]):
    """One row with count, mean, sd, least, greatest and cut points (``n0, m0, s0, l0, g0, b0, n1, ...``) of every column."""
    probs = F.array(*[F.lit(p) for p in _bound_probs(df)])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"l{i}"),
                 F.max(x).alias(f"g{i}"), F.percentile_approx(x, probs, 8 * _buckets(df)).alias(f"b{i}")]
    return df.agg(*aggs).first()


# ---------------------------------------------------------------- relational
def distinct_rows(df: DataFrame) -> DataFrame:
    """A5: group-by-all = distinct."""
    return df.distinct()


def keep_first(df: DataFrame, keys: list[str], order: list[str], descending: bool = False) -> DataFrame:
    """One row per key, first in ``order`` (ascending or descending; give a unique tie-break).

    An aggregate (``min_by`` / ``max_by`` over the whole row), so a key holding
    a large share of the rows is reduced map-side instead of sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    pick = F.max_by(row, ordering) if descending else F.min_by(row, ordering)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def repeated_mask(df: DataFrame, key: str, out: str = "repeated") -> DataFrame:
    """Flag all members of groups whose non-null key occurs more than once (aggregate + join)."""
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return (df.join(n, key, "left")
              .withColumn(out, F.when(F.col(key).isNotNull() & (F.col("_n") > 1), True).otherwise(False)).drop("_n"))


def group_means(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """A10: mean of numeric columns per group, nulls skipped."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def group_median(df: DataFrame, keys: list[str], col: str, approx: bool = False) -> DataFrame:
    """Exact interpolated median per group (``approx`` uses percentile_approx)."""
    if approx:
        return df.groupBy(*keys).agg(F.percentile_approx(F.col(col).cast("double"), 0.5, 100000).alias(f"median_{col}"))
    return exact_quantiles(df, keys, col, [0.5], [f"median_{col}"])


def share_of_total(df: DataFrame, keys: list[str]) -> DataFrame:
    """Count per group and its share of all rows."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()  # scalar subquery
    return g.select(*keys, "n", (F.col("n") / total).alias("share"))


def group_mode(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Most frequent non-null value per group, ties to the smallest value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(col))
    return (counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
                  .select(*keys, F.col(col).alias(f"mode_{col}"), F.col("_n").alias("mode_count")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A14."""
    return df.groupBy(col).agg(F.count("*").alias("count"))


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts in long form (pivot with ``crosstab_wide``)."""
    return df.groupBy(a, b).agg(F.count("*").alias("count"))


def crosstab_wide(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a).pivot(b).count()


def describe(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, std, min, 25/50/75% (exact, interpolated), max; long form.

    Two passes whatever the number of columns: one aggregate for the moments and
    cut points, one unpivoted rank pass for all quantiles of all columns.  Only
    these few numbers a column reach the driver.
    """
    names, probs = ["25%", "50%", "75%"], [0.25, 0.5, 0.75]
    s = _column_summary(df, cols)
    bounds = _per_column({c: _doubles(_bounds_of(s[f"b{i}"])) for i, c in enumerate(cols)})
    ranks = rank_ranges(_value_counts_of(df, cols), "_x", "_c", ["column_name"], _bucket(bounds, F.col("_x")))
    q = {r["column_name"]: r for r in ranks.groupBy("column_name").agg(*_at_positions(probs, names))
         .select("column_name", *[_interpolated(n).alias(n) for n in names]).collect()}
    rows = [(c, float(s[f"n{i}"]), s[f"m{i}"], s[f"s{i}"], s[f"l{i}"], *((q[c][n] if c in q else None) for n in names), s[f"g{i}"])
            for i, c in enumerate(cols)]
    stats = ["count", "mean", "std", "min", *names, "max"]
    one = df.sparkSession.createDataFrame(rows, "column_name string, " + ", ".join(f"`{n}` double" for n in stats))
    exact = ("count", "min", "max")
    pairs = ", ".join(f"'{n}', " + (f"`{n}`" if n in exact else f"round(`{n}`, {digits})") for n in stats)
    return one.selectExpr("column_name", f"stack({len(stats)}, {pairs}) AS (stat, value)")


def describe_extended(df: DataFrame, cols: list[str], digits: int = 6, trim: float = 0.1) -> DataFrame:
    """N, mean, sd, median, trimmed mean, mad, min, max, range, skew, kurtosis, se.

    skew and kurtosis are the type-3 sample forms (b1, b2 - 3); mad is
    1.4826 x median absolute deviation; the trimmed mean drops floor(trim*n)
    values from each end, handling ties at the cut exactly.  Three passes
    whatever the number of columns: moments and cut points, ranks of all values
    (median, trimmed sum, central moments), ranks of all deviations (mad).
    """
    s = _column_summary(df, cols)
    cuts = {c: _bounds_of(s[f"b{i}"]) for i, c in enumerate(cols)}
    counts, x, c = _value_counts_of(df, cols), F.col("_x"), F.col("_c")
    ranks = rank_ranges(counts, "_x", "_c", ["column_name"], _bucket(_per_column({k: _doubles(v) for k, v in cuts.items()}), x))
    off = x - _per_column({k: F.lit(s[f"m{i}"]).cast("double") for i, k in enumerate(cols)})
    cut = F.floor(F.col("_n") * F.lit(float(trim)))
    keep = F.greatest(F.lit(0), F.least(F.col("_hi"), F.col("_n") - cut) - F.greatest(F.col("_lo"), cut))
    q = {r["column_name"]: r for r in ranks.groupBy("column_name").agg(
        *_at_positions([0.5], ["median"]), F.sum(x * keep).alias("tsum"), F.sum(keep).alias("tn"),
        *[(F.sum(c * F.pow(off, k)) / F.sum(c)).alias(f"m{k}") for k in (2, 3, 4)])
        .select("column_name", _interpolated("median"), "tsum", "tn", "m2", "m3", "m4").collect()}
    # a range of deviations lies in at most two ranges of values, so the same cut points serve, folded at the median
    folded = {k: _doubles(sorted({abs(v - q[k]["median"]) for v in vs})) for k, vs in cuts.items() if k in q}
    mad = {}
    if folded:
        median = _per_column({k: F.lit(q[k]["median"]) for k in folded})
        away = counts.select("column_name", F.abs(x - median).alias("_x"), "_c").groupBy("column_name", "_x").agg(F.sum("_c").alias("_c"))
        ranks = rank_ranges(away, "_x", "_c", ["column_name"], _bucket(_per_column(folded), x))
        mad = {r["column_name"]: r["mad0"] for r in ranks.groupBy("column_name").agg(*_at_positions([0.5], ["mad0"]))
               .select("column_name", _interpolated("mad0")).collect()}
    rows = []
    for i, k in enumerate(cols):
        r = q.get(k)
        rows.append((k, s[f"n{i}"], s[f"m{i}"], s[f"s{i}"], *((r[f] if r else None) for f in ("median", "tsum", "tn")), mad.get(k),
                     s[f"l{i}"], s[f"g{i}"], *((r[f] if r else None) for f in ("m2", "m3", "m4"))))
    one = df.sparkSession.createDataFrame(
        rows, "column_name string, n long, mean double, sd double, median double, tsum double, tn long, mad0 double, "
              "min double, max double, m2 double, m3 double, m4 double")
    return one.select(
        "column_name", F.col("n").cast("double").alias("n"),
        F.round("mean", digits).alias("mean"), F.round("sd", digits).alias("sd"),
        F.round("median", digits).alias("median"),
        F.round(F.try_divide(F.col("tsum"), F.col("tn")), digits).alias("trimmed"),
        F.round(F.col("mad0") * 1.4826, digits).alias("mad"),
        F.col("min"), F.col("max"), (F.col("max") - F.col("min")).alias("range"),
        F.round(F.try_divide(F.col("m3"), F.pow("m2", 1.5)) * F.pow(F.try_divide(F.col("n") - 1, F.col("n")), 1.5), digits).alias("skew"),
        F.round(F.try_divide(F.col("m4"), F.pow("m2", 2)) * F.pow(F.try_divide(F.col("n") - 1, F.col("n")), 2) - 3, digits).alias("kurtosis"),
        F.round(F.try_divide(F.col("sd"), F.sqrt("n")), digits).alias("se"))


def scalar_stats(df: DataFrame, col: str) -> DataFrame:
    """Max / mean / std / row count in one pass."""
    x = F.col(col).cast("double")
    return df.agg(F.count("*").alias("rows"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"))


def corr_long(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for each column pair, long form (one pass)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', round(`{a}__{b}`, {digits})" for a, b in pairs)
    return one.selectExpr(f"stack({len(pairs)}, {stack}) AS (left_col, right_col, corr)")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the max falls in the last bin."""
    x = F.col(col).cast("double")
    binned = (df.select(x.alias("x")).where(F.col("x").isNotNull())
                .withColumn("lo", df.agg(F.min(x)).scalar()).withColumn("hi", df.agg(F.max(x)).scalar()))
    w = (F.col("hi") - F.col("lo")) / bins
    binned = (binned.withColumn("bin", F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), w)), F.lit(bins - 1))
                            .cast("int")))
    return (binned.groupBy("bin", "lo", "hi").agg(F.count("*").alias("count"))
                  .select(F.coalesce("bin", F.lit(0)).alias("bin"),
                          (F.col("lo") + F.coalesce("bin", F.lit(0)) * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
                          "count"))


def quantiles_by_step(samples: DataFrame, step: str = "step", value: str = "value",
                      probs=(0.025, 0.5, 0.975), digits: int = 6) -> DataFrame:
    """Interval bounds and median of a sample table per step."""
    names = ["lower", "median", "upper"] if len(probs) == 3 else [f"q{i}" for i in range(len(probs))]
    g = exact_quantiles(samples, [step], value, probs, names)
    return g.select(step, *[F.round(n, digits).alias(n) for n in names])


def prob_vs_level(samples: DataFrame, level: float, step: str = "step", value: str = "value") -> DataFrame:
    """Share of samples above (or below) a level per step.

    The side is chosen by the direction of the first step's median relative
    to the level: up -> P(v > level), otherwise P(v < level).
    """
    v = F.col(value).cast("double")
    g = samples.groupBy(step).agg(F.avg((v > level).cast("double")).alias("p_up"),
                                  F.avg((v < level).cast("double")).alias("p_down"))
    g = g.join(exact_quantiles(samples, [step], value, [0.5], ["med"]), step)
    first = g.agg(F.min_by("med", step)).scalar()
    return (g.withColumn("med1", first)
             .select(step, F.when(F.col("med1") > level, F.lit("up")).otherwise(F.lit("down")).alias("direction"),
                     F.when(F.col("med1") > level, F.col("p_up")).otherwise(F.col("p_down")).alias("probability")))


def regression_line(df: DataFrame, y: str, x: str, digits: int = 6) -> DataFrame:
    """Least-squares slope, intercept and r^2 of y on x."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return df.agg(F.round(F.regr_slope(yy, xx), digits).alias("slope"),
                  F.round(F.regr_intercept(yy, xx), digits).alias("intercept"),
                  F.round(F.regr_r2(yy, xx), digits).alias("r2"),
                  F.regr_count(yy, xx).alias("n"))


# ---------------------------------------------------------------- evaluation
def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Counts per (actual, predicted)."""
    return df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("count"))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, f1, support per class plus accuracy / macro / weighted rows."""
    cm = confusion(df, y, pred)
    tp = cm.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("cls"), F.col("count").alias("tp"))
    sup = cm.groupBy(F.col("actual").alias("cls")).agg(F.sum("count").alias("support"))
    prd = cm.groupBy(F.col("predicted").alias("cls")).agg(F.sum("count").alias("npred"))
    per = (sup.join(prd, "cls", "full").join(tp, "cls", "left")
              .select(F.col("cls").cast("string").alias("label"),
                      F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("support", F.lit(0)).alias("support"),
                      F.coalesce("npred", F.lit(0)).alias("npred")))
    per = (per.withColumn("precision", F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred").cast("double")), F.lit(0.0)))
              .withColumn("recall", F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0)))
              .withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                                        F.col("precision") + F.col("recall")), F.lit(0.0))))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     (F.col("tp").cast("double") / F.col("n").cast("double")).alias("f1"), F.col("n").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), (F.col("wp") / F.col("n")).alias("precision"),
                          (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                          F.col("n").alias("support"))
    rows = per.select("label", "precision", "recall", "f1", "support")
    out = rows.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


def accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    """M27."""
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count("*").alias("n"))


def roc_points(df: DataFrame, y: str, score: str, buckets: int = 64) -> DataFrame:
    """One ROC point per distinct score threshold (ties grouped, X17).

    Thresholds are distinct scores; running counts in descending score order
    come from the parallel prefix sum, so a continuous score does not put
    the curve on one task.
    """
    per = (df.groupBy(F.col(score).cast("double").alias("threshold"))
             .agg(F.sum(F.col(y).cast("long")).alias("tp_at"),
                  F.sum((1 - F.col(y)).cast("long")).alias("fp_at"))
             .withColumn("neg_threshold", -F.col("threshold")))
    cum = prefix_sums(per, ["neg_threshold"], ["tp_at", "fp_at"], buckets)
    P = df.agg(F.sum(F.col(y).cast("long"))).scalar()
    N = df.agg(F.sum((1 - F.col(y)).cast("long"))).scalar()
    return (cum.withColumn("P", P).withColumn("N", N)
               .select("threshold", F.col("cum_tp_at").alias("tp"), F.col("cum_fp_at").alias("fp"),
                       (F.col("cum_tp_at") / F.col("P")).alias("tpr"), (F.col("cum_fp_at") / F.col("N")).alias("fpr")))


def auc(df: DataFrame, y: str, score: str, buckets: int = 64) -> DataFrame:
    """Area under the ROC curve by the rank-sum (Mann-Whitney) formula.

    AUC = sum over thresholds of pos(s) * (neg below s + neg at s / 2) / (P N):
    identical to the trapezoid over the tie-grouped ROC points.
    """
    per = (df.groupBy(F.col(score).cast("double").alias("s"))
             .agg(F.sum(F.col(y).cast("long")).alias("pos"), F.sum((1 - F.col(y)).cast("long")).alias("neg")))
    cum = prefix_sums(per, ["s"], ["neg"], buckets, inclusive=False)
    return (cum.agg(F.sum(F.col("pos") * (F.col("cum_neg") * 2 + F.col("neg"))).alias("num2"),
                    F.sum("pos").alias("P"), F.sum("neg").alias("N"))
               .select((F.col("num2").cast("double") / (2.0 * F.col("P") * F.col("N"))).alias("auc"),
                       F.col("P").alias("positives"), F.col("N").alias("negatives")))


def anova_oneway(df: DataFrame, y: str, group: str, digits: int = 6) -> DataFrame:
    """One-way ANOVA F statistic with its degrees of freedom."""
    yy = F.col(y).cast("double")
    g = df.groupBy(group).agg(F.count(yy).alias("n"), F.avg(yy).alias("m"), F.var_pop(yy).alias("v"))
    gm = df.agg(F.avg(yy)).scalar()
    s = (g.withColumn("gm", gm)
          .agg(F.sum(F.col("n") * F.pow(F.col("m") - F.col("gm"), 2)).alias("ssb"),
               F.sum(F.col("n") * F.col("v")).alias("ssw"), F.count("*").alias("k"), F.sum("n").alias("n")))
    return s.select(F.round("ssb", digits - 2).alias("ss_between"), F.round("ssw", digits - 2).alias("ss_within"),
                    (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"),
                    F.round((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n") - F.col("k"))), digits)
                    .alias("f"))


def chisq(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """Pearson chi-square statistic of the a x b table and its df."""
    # sum (O-E)^2/E over all cells = sum over observed cells of O^2/E - n,
    # so empty cells never need to be materialised.
    obs = df.groupBy(a, b).agg(F.count("*").alias("o"))
    ra = df.groupBy(a).agg(F.count("*").alias("ra"))
    cb = df.groupBy(b).agg(F.count("*").alias("cb"))
    n = df.agg(F.count("*")).scalar()
    e = F.col("ra") * F.col("cb") / n
    return (obs.join(ra, a).join(cb, b)
               .agg((F.sum(F.col("o") * F.col("o") / e) - n).alias("chi2"),
                    F.count_distinct(a).alias("r"), F.count_distinct(b).alias("c"))
               .select(F.round("chi2", digits).alias("chi2"), ((F.col("r") - 1) * (F.col("c") - 1)).alias("df")))


def cluster_profile(df: DataFrame, cluster: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Per cluster the mean of each numeric column and the mode of each factor."""
    out = group_means(df, [cluster], numeric).withColumn("size", F.lit(None).cast("bigint"))
    sizes = df.groupBy(cluster).agg(F.count("*").alias("size"))
    out = out.drop("size").join(sizes, cluster)
    for c in categorical:
        out = out.join(group_mode(df, [cluster], c).drop("mode_count"), cluster, "left")
    return out
