"""Metrics and error analysis as aggregate queries.

Every function takes a DataFrame with a true and a predicted column (names are parameters), and
``by`` columns for per-group results (per model, per split). Each is one or two aggregate jobs;
partial aggregation happens map-side, so a hot group costs no more than its share of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.errors import (
    focal_smape_term,
    half_smape_term,
    huber_smape_term,
    is_missing,
    log_smape_term,
    percent_error,
    range_label,
    smape_term,
)
from ..session import cut_lineage
from .quantiles import count_at_most, edges_list, exact_percentiles, percentile_edges
from .groups import beside_groups, join_groups


def _pairs(df: DataFrame, t: str, p: str, by, in_log_space: bool = False) -> DataFrame:
    tc, pc = F.col(t).cast("double"), F.col(p).cast("double")
    if in_log_space:
        tc, pc = F.expm1(tc), F.expm1(pc)
    return df.select(*[F.col(b) for b in by], tc.alias("_t"), pc.alias("_p"))


def smape_agg(t: Column, p: Column, eps: float = C.SMAPE_EPS) -> Column:
    """A01 as an aggregate expression: 100 * avg(term)."""
    return 100.0 * F.avg(smape_term(t, p, eps))


def smape(df: DataFrame, t: str = "y_true", p: str = "pred", by=(), eps: float = C.SMAPE_EPS) -> DataFrame:
    """A01 (one row per group)."""
    by = list(by)
    x = _pairs(df, t, p, by)
    return x.groupBy(*by).agg(smape_agg(F.col("_t"), F.col("_p"), eps).alias("smape"))


def neg_smape(df: DataFrame, t: str = "y_true", p: str = "pred", by=(), from_log: bool = False) -> DataFrame:
    """Scorer value (higher is better); plan variant back-transforms first."""
    by = list(by)
    x = _pairs(df, t, p, by, in_log_space=from_log)
    return x.groupBy(*by).agg((-smape_agg(F.col("_t"), F.col("_p"))).alias("neg_smape"))


def evaluation_record(df: DataFrame, t: str = "y_true", p: str = "pred", by=(), in_log_space: bool = False) -> DataFrame:
    """Smape, mae, rmse, mape, r2 in one aggregate.

    r2 = 1 - SS_res / SS_tot with SS_tot = var_pop(t) * n (a one-pass form of sum((t-mean)^2));
    constant target gives 1.0 when the residual is 0 else 0.0; fewer than 2 rows give NaN.
    """
    by = list(by)
    x = _pairs(df, t, p, by, in_log_space)
    tc, pc = F.col("_t"), F.col("_p")
    agg = x.groupBy(*by).agg(
        smape_agg(tc, pc).alias("smape"),
        F.avg(F.abs(tc - pc)).alias("mae"),
        F.sqrt(F.avg((tc - pc) * (tc - pc))).alias("rmse"),
        (100.0 * F.avg(F.abs((tc - pc) / (tc + F.lit(C.MAPE_EPS))))).alias("mape"),
        F.sum((tc - pc) * (tc - pc)).alias("_ss_res"),
        (F.var_pop(tc) * F.count(tc)).alias("_ss_tot"),
        F.count(F.lit(1)).alias("_n"),
    )
    r2 = (
        F.when(F.col("_n") < 2, F.lit(float("nan")))
        .when(F.col("_ss_tot") == 0, F.when(F.col("_ss_res") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(1 - F.col("_ss_res") / F.col("_ss_tot"))
    )
    return agg.select(*by, "smape", "mae", "rmse", "mape", r2.alias("r2"))


def _edges_column(df: DataFrame, value: str, probs: list[float], by: list[str], approx: bool = False):
    """(frame with an ``_edges`` array column, per row) - literal when ungrouped, join when grouped.
    ``approx``: ``percentile_approx`` edges (one aggregate) instead of the exact ones."""
    if not by:
        edges = edges_list(df, value, probs, approx=approx)
        return df.withColumn("_edges", F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>"))
    e = percentile_edges(df, value, probs, by, approx=approx).withColumnRenamed("edges", "_edges")
    return beside_groups(df, e, by)


def smape_by_quantile(df: DataFrame, t: str = "y_true", p: str = "pred", n_quantiles: int = 5, by=(),
                      approx: bool = False) -> DataFrame:
    """SMAPE per price quantile of the true value.

    Interior edges only; a value equal to an edge goes to the upper bin; empty bins are absent; ids
    start at 1. Columns: quantile, price_range, price_min, price_max, count, smape.
    """
    by = list(by)
    x = _pairs(df, t, p, by).where(~is_missing(F.col("_t")))
    probs = [i / n_quantiles for i in range(1, n_quantiles)]
    if n_quantiles <= 1:
        xe = x.withColumn("_edges", F.array(F.lit(float("inf"))))  # never used: count_at_most over 0 splits
    else:
        xe = _edges_column(x, "_t", probs, by, approx)
    binned = xe.select(*by, "_t", "_p", (1 + count_at_most(F.col("_t"), lambda i: F.col("_edges")[i], len(probs))).alias("quantile"))
    agg = binned.groupBy(*by, "quantile").agg(
        F.min("_t").alias("price_min"), F.max("_t").alias("price_max"), F.count(F.lit(1)).alias("count"),
        smape_agg(F.col("_t"), F.col("_p")).alias("smape"),
    )
    return agg.select(*by, F.col("quantile").cast("int").alias("quantile"),
                      range_label(F.col("price_min"), F.col("price_max")).alias("price_range"),
                      "price_min", "price_max", "count", "smape")


def smape_by_qcut(df: DataFrame, t: str = "y_true", p: str = "pred", n_quantiles: int = 5, by=(),
                  approx: bool = False) -> DataFrame:
    """A05 (plan variant): qcut bins - distinct edges, right-closed, ids from 0; min, max, mean price."""
    by = list(by)
    x = _pairs(df, t, p, by).where(~is_missing(F.col("_t")))
    probs = [i / n_quantiles for i in range(1, n_quantiles)]
    xe = _edges_column(x, "_t", probs, by, approx)
    binned = xe.select(*by, "_t", "_p",
                       F.size(F.filter(F.array_distinct("_edges"), lambda e: F.col("_t") > e)).alias("quantile"))
    return binned.groupBy(*by, "quantile").agg(
        F.count(F.lit(1)).alias("count"), F.min("_t").alias("min_price"), F.max("_t").alias("max_price"),
        F.avg("_t").alias("mean_price"), smape_agg(F.col("_t"), F.col("_p")).alias("smape"),
    ).select(*by, F.col("quantile").cast("int").alias("quantile"), "count", "min_price", "max_price", "mean_price", "smape")


def price_range_index(t: Column) -> Column:
    """A06 bin of the fixed price ranges; NULL for values outside [0, inf)."""
    edges = C.PRICE_RANGE_EDGES
    idx = None
    for i in range(len(edges) - 1):
        cond = (t >= edges[i]) & (t < edges[i + 1])
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    return idx


def smape_by_price_range(df: DataFrame, t: str = "y_true", p: str = "pred", by=()) -> DataFrame:
    """Half-SMAPE per fixed price range; all ranges listed (0 and n=0 when empty) plus the
    overall mean. The 7-row range table is a fixed constant, broadcast on purpose."""
    by = list(by)
    x = _pairs(df, t, p, by).select(*by, price_range_index(F.col("_t")).alias("range_idx"),
                                     half_smape_term(F.col("_t"), F.col("_p")).alias("_e"))
    per = x.where(F.col("range_idx").isNotNull()).groupBy(*by, "range_idx").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_e").alias("_m"))
    overall = x.groupBy(*by).agg(F.avg("_e").alias("overall_smape"))
    labels = F.array(*[F.struct(F.lit(i).alias("range_idx"), F.lit(lab).alias("price_range"))
                       for i, lab in enumerate(C.PRICE_RANGE_LABELS)])
    grid = overall.select(*by, "overall_smape", F.explode(labels).alias("_r")).select(
        *by, "overall_smape", "_r.range_idx", "_r.price_range")
    out = join_groups(grid, per, by + ["range_idx"], "left")
    return out.select(*by, "range_idx", "price_range", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                      F.coalesce("_m", F.lit(0.0)).alias("mean_smape"), "overall_smape")


def error_summary(df: DataFrame, t: str = "y_true", p: str = "pred", by=()) -> DataFrame:
    """Mean and median absolute error, median percent error (both medians from one exact
    percentile job over the unpivoted errors)."""
    by = list(by)
    x = _pairs(df, t, p, by).select(*by, F.abs(F.col("_p") - F.col("_t")).alias("abs_error"),
                                     percent_error(F.col("_t"), F.col("_p")).alias("pct_error"))
    means = x.groupBy(*by).agg(F.avg("abs_error").alias("mean_abs_error"))
    long = x.unpivot(by, ["abs_error", "pct_error"], "_m", "_e")
    med = exact_percentiles(long, "_e", [0.5], by + ["_m"]).groupBy(*by).agg(
        F.max(F.when(F.col("_m") == "abs_error", F.col("value"))).alias("median_abs_error"),
        F.max(F.when(F.col("_m") == "pct_error", F.col("value"))).alias("median_pct_error"))
    if not by:
        r = med.collect()[0]
        return means.select("*", F.lit(r["median_abs_error"]).cast("double").alias("median_abs_error"),
                            F.lit(r["median_pct_error"]).cast("double").alias("median_pct_error"))
    return join_groups(means, med, by)


def histogram(df: DataFrame, value: str, bins: int = 50, by=()) -> DataFrame:
    """Equal-width histogram over [min, max] (numpy rule: last bin closed; a constant column
    uses [v-0.5, v+0.5]); every bin listed, zero-filled. Columns: bin, lo, hi, n."""
    by = list(by)
    x = df.select(*by, F.col(value).cast("double").alias("_x")).where(~is_missing(F.col("_x")))
    rng = x.groupBy(*by).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    rng = rng.select(*by, F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_a"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_b"))
    step = (F.col("_b") - F.col("_a")) / bins
    if by:
        rng = cut_lineage(rng)
        xr = beside_groups(x, rng, by)
    else:
        r = rng.collect()
        if not r:
            return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long")
        xr = x.withColumn("_a", F.lit(r[0]["_a"])).withColumn("_b", F.lit(r[0]["_b"]))
    raw = F.floor((F.col("_x") - F.col("_a")) * (F.lit(float(bins)) / (F.col("_b") - F.col("_a")))).cast("int")
    i0 = F.when(raw >= bins, bins - 1).otherwise(raw)
    edge = lambda i: F.when(i >= bins, F.col("_b")).otherwise(i * step + F.col("_a"))
    i1 = F.when(F.col("_x") < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((F.col("_x") >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    counts = xr.select(*by, i2.alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*by, "_a", "_b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.select(*by, "bin", (F.col("bin") * step + F.col("_a")).alias("lo"),
                       edge(F.col("bin") + 1).alias("hi"))
    return join_groups(grid, counts, by + ["bin"], "left").select(*by, "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def split_histogram(df: DataFrame, value: str, split_col: str = "split", ref_split: str = "train", bins: int = 50,
                    log1p: bool = True) -> DataFrame:
    """Histogram of log1p(value) per split on ``bins`` edges spanning the reference split
    (``bins - 1`` bins); out-of-range values drop out; last bin closed."""
    v = F.log1p(F.col(value)) if log1p else F.col(value).cast("double")
    x = df.select(F.col(split_col).alias("split"), v.alias("_x")).where(~is_missing(F.col("_x")))
    r = x.where(F.col("split") == ref_split).agg(F.min("_x").alias("a"), F.max("_x").alias("b")).collect()[0]
    if r["a"] is None:
        return df.sparkSession.createDataFrame([], "split string, bin int, lo double, hi double, n long")
    a, b = r["a"], r["b"]
    step = (b - a) / (bins - 1)
    edges = [a + i * step for i in range(bins - 1)] + [b]
    arr = F.array(*[F.lit(float(e)) for e in edges])
    binned = x.where((F.col("_x") >= a) & (F.col("_x") <= b)).select(
        "split", F.least(F.size(F.filter(arr, lambda e: e <= F.col("_x"))) - 1, F.lit(bins - 2)).alias("bin"))
    counts = binned.groupBy("split", "bin").agg(F.count(F.lit(1)).alias("n"))
    splits = x.select("split").distinct()
    grid = splits.select("split", F.explode(F.sequence(F.lit(0), F.lit(bins - 2))).alias("bin"))
    grid = grid.select("split", "bin", F.try_element_at(arr, F.col("bin") + 1).alias("lo"), F.try_element_at(arr, F.col("bin") + 2).alias("hi"))
    return join_groups(grid, counts, ["split", "bin"], "left").select("split", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def box_summary(df: DataFrame, value: str, by=()) -> DataFrame:
    """A10: quartiles, whiskers at 1.5 IQR (the extreme data points inside), mean, n."""
    by = list(by)
    x = df.select(*by, F.col(value).cast("double").alias("_x")).where(~is_missing(F.col("_x")))
    q = exact_percentiles(x, "_x", [0.25, 0.5, 0.75], by)
    qw = q.groupBy(*by).agg(
        F.max(F.when(F.col("p_idx") == 0, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p_idx") == 1, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p_idx") == 2, F.col("value"))).alias("q3"),
    )
    if by:
        xq = beside_groups(x, qw, by)
    else:
        r = qw.collect()[0]
        xq = x.select("_x", F.lit(r["q1"]).alias("q1"), F.lit(r["median"]).alias("median"), F.lit(r["q3"]).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    agg = xq.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(F.col("_x") >= F.col("q1") - 1.5 * iqr, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= F.col("q3") + 1.5 * iqr, F.col("_x"))).alias("whisker_hi"),
        F.avg("_x").alias("mean"), F.count(F.lit(1)).alias("n"),
    )
    return agg.select(*by, "n", "mean", "q1", "median", "q3", "whisker_lo", "whisker_hi")


def nan_stats(df: DataFrame, value: str, by=()) -> DataFrame:
    """Min, max, mean, median, population std ignoring NaN/NULL."""
    by = list(by)
    x = df.select(*by, F.col(value).cast("double").alias("_x")).where(~is_missing(F.col("_x")))
    agg = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"),
                             F.avg("_x").alias("mean"), F.stddev_pop("_x").alias("std"))
    if not by:
        m = edges_list(x, "_x", [0.5])
        return agg.select("*", F.lit(m[0] if m else None).cast("double").alias("median"))
    med = exact_percentiles(x, "_x", [0.5], by).select(*by, F.col("value").alias("median"))
    return join_groups(agg, med, by, "left")


def leaderboard(df: DataFrame, t: str = "y_true", p: str = "pred", model_col: str = "model") -> DataFrame:
    """SMAPE per model, best first, rank and best flag."""
    s = smape(df, t, p, by=[model_col])
    w = Window.orderBy(F.col("smape"), F.col(model_col))  # one row per model: bounded
    return s.select(model_col, "smape", F.row_number().over(w).alias("rank")).withColumn("is_best", F.col("rank") == 1)


def improvement(board: DataFrame, reference: str, model_col: str = "model") -> DataFrame:
    """Improvement (reference SMAPE - model SMAPE) of every model over ``reference``."""
    ref = board.where(F.col(model_col) == reference).select("smape").collect()  # one number
    if not ref:
        raise ValueError(f"reference model {reference!r} not in the leaderboard")
    return board.select(model_col, "smape", (F.lit(ref[0]["smape"]) - F.col("smape")).alias("improvement"))


def loss_values(df: DataFrame, pred_log: str, true_log: str, by=(), delta: float = C.HUBER_DELTA,
                gamma: float = C.FOCAL_GAMMA, alpha: float = C.FOCAL_ALPHA) -> DataFrame:
    """Huber, focal and plain log-space SMAPE losses (x100, mean)."""
    by = list(by)
    p, t = F.col(pred_log).cast("double"), F.col(true_log).cast("double")
    return df.groupBy(*by).agg(
        (100.0 * F.avg(huber_smape_term(p, t, delta))).alias("huber_smape"),
        (100.0 * F.avg(focal_smape_term(p, t, gamma, alpha))).alias("focal_smape"),
        (100.0 * F.avg(log_smape_term(p, t))).alias("smape_loss"),
    )


LOSSES = {
    "huber_smape": lambda p, t, **kw: huber_smape_term(p, t, kw.get("delta", C.HUBER_DELTA)),
    "focal_smape": lambda p, t, **kw: focal_smape_term(p, t, kw.get("gamma", C.FOCAL_GAMMA), kw.get("alpha", C.FOCAL_ALPHA)),
    "smape": lambda p, t, **kw: log_smape_term(p, t),
}


def loss_function(loss_type: str = "huber_smape", **kw):
    """Loss selection by name -> aggregate-expression builder ``(pred, true) -> Column``."""
    if loss_type not in LOSSES:
        raise ValueError(f"Unknown loss type: {loss_type}. Choose from: {', '.join(repr(k) for k in LOSSES)}")
    term = LOSSES[loss_type]
    return lambda p, t: 100.0 * F.avg(term(p, t, **kw))


def duplicate_ids(df: DataFrame, key: str = "sample_id") -> DataFrame:
    """Ids that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def target_check(board: DataFrame, target: float = C.TARGET_SMAPE) -> DataFrame:
    """Achieved (SMAPE below the target) per leaderboard row."""
    return board.select("*", (F.col("smape") < F.lit(target)).alias("meets_target"))


def qq_fit(df: DataFrame, value: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Normal Q-Q fit (slope, intercept, r) with Filliben plotting positions, one row per group of ``by``.

    Needs the rank of every row in its group; ``global_rank`` gives it without a window over a whole group. Missing
    values are left out; a group of one row has no slope; without rows there is no fit."""
    from .windows import global_rank

    by = list(by)
    x = df.select(*by, F.col(value).cast("double").alias("_x")).where(~is_missing(F.col("_x")))
    ranked = global_rank(x, ["_x"], by)
    sizes = cut_lineage(x.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")))
    if by:
        ranked = beside_groups(ranked, sizes, by)
    else:
        ranked = ranked.withColumn("_n", F.lit(sizes.first()["_n"]))
    i, n = F.col("_rank") + 1, F.col("_n")
    mn = F.pow(F.lit(0.5), F.lit(1.0) / n)
    m = F.when(i == 1, 1 - mn).when(i == n, mn).otherwise((i - 0.3175) / (n + 0.365))
    pts = ranked.select(*by, inverse_normal_cdf(m).alias("osm"), F.col("_x").alias("osr"))
    fit = pts.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.regr_slope("osr", "osm").alias("slope"),
                               F.regr_intercept("osr", "osm").alias("intercept"), F.corr("osm", "osr").alias("r"))
    return fit.where("n > 0")


# FIXED VALUES (Acklam's rational approximation of the inverse normal CDF; public coefficients)
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
      -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
      -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
      4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]


def _poly(coefs, x):
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def inverse_normal_cdf(p: Column) -> Column:
    """Column expression for the standard normal quantile (relative error ~1e-9)."""
    plow, phigh = 0.02425, 1 - 0.02425
    q_lo = F.sqrt(-2 * F.log(p))
    lo = _poly(_C, q_lo) / (_poly(_D, q_lo) * q_lo + 1)
    q_hi = F.sqrt(-2 * F.log(1 - p))
    hi = -_poly(_C, q_hi) / (_poly(_D, q_hi) * q_hi + 1)
    q = p - 0.5
    r = q * q
    mid = _poly(_A, r) * q / (_poly(_B, r) * r + 1)
    return F.when(p < plow, lo).when(p > phigh, hi).otherwise(mid)
