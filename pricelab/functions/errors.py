"""M01-M06, P09-P11, P14, A23-A25 row terms, F16-F18: per-row error and transform expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def is_missing(c: Column) -> Column:
    """NULL or NaN (pandas treats both as missing)."""
    return c.isNull() | F.isnan(c)


def log_target(price: Column) -> Column:
    """M01."""
    return F.log1p(price)


def from_log(x: Column) -> Column:
    """M02."""
    return F.expm1(x)


def smape_term(t: Column, p: Column, eps: float = C.SMAPE_EPS) -> Column:
    """A01 row term: |p-t| / ((|t|+|p|)/2 + eps)."""
    return F.abs(p - t) / ((F.abs(t) + F.abs(p)) / 2.0 + F.lit(eps))


def half_smape_term(t: Column, p: Column, eps: float = C.SMAPE_EPS) -> Column:
    """D4 plot variant: 100 |p-t| / (|t|+|p|+eps), range 0..100."""
    return 100.0 * F.abs(p - t) / (F.abs(t) + F.abs(p) + F.lit(eps))


def percent_error(t: Column, p: Column, eps: float = C.SMAPE_EPS) -> Column:
    """Signed 100 (p-t) / (|t|+|p|+eps)."""
    return 100.0 * (p - t) / (F.abs(t) + F.abs(p) + F.lit(eps))


def residual(t: Column, p: Column) -> Column:
    """M04."""
    return p - t


def relative_percent_error(t: Column, p: Column) -> Column:
    """M04 plan variant: (p-t)/t*100, NULL for t = 0."""
    return F.try_divide(p - t, t) * 100.0


def clipped_exp(x: Column, eps: float = C.SMAPE_EPS) -> Column:
    """expm1 then floor at eps (log-space losses)."""
    return F.greatest(F.expm1(x), F.lit(eps))


def log_smape_term(pred_log: Column, true_log: Column, eps: float = C.SMAPE_EPS) -> Column:
    """A25 row term: SMAPE of clipped expm1 values."""
    p = clipped_exp(pred_log, eps)
    t = clipped_exp(true_log, eps)
    return F.abs(p - t) / ((F.abs(t) + F.abs(p)) / 2.0 + F.lit(eps))


def huber_smape_term(pred_log: Column, true_log: Column, delta: float = C.HUBER_DELTA, eps: float = C.SMAPE_EPS) -> Column:
    """A23 row term: r^2/(2 delta) for r <= delta else r - delta/2."""
    r = log_smape_term(pred_log, true_log, eps)
    return F.when(r <= delta, 0.5 * r * r / delta).otherwise(r - 0.5 * delta)


def focal_smape_term(pred_log: Column, true_log: Column, gamma: float = C.FOCAL_GAMMA, alpha: float = C.FOCAL_ALPHA,
                     eps: float = C.SMAPE_EPS) -> Column:
    """A24 row term: alpha (r/2 + eps)^gamma r."""
    r = log_smape_term(pred_log, true_log, eps)
    return alpha * F.pow(r / 2.0 + eps, gamma) * r


def smape_grad_hess(pred_log: Column, true_log: Column, eps: float = C.SMAPE_EPS) -> tuple[Column, Column]:
    """Gradient and hessian of SMAPE w.r.t. the log-space prediction."""
    p = F.greatest(F.expm1(pred_log), F.lit(eps))
    t = F.greatest(F.expm1(true_log), F.lit(eps))
    d = p - t
    s = F.abs(t) + F.abs(p) + eps
    g_raw = 2.0 * F.signum(d) / s - 2.0 * F.abs(d) * F.signum(p) / (s * s)
    g = g_raw * p
    h = F.least(F.greatest(2.0 * p * p / (s * s), F.lit(C.HESSIAN_CLIP[0])), F.lit(C.HESSIAN_CLIP[1]))
    return g, h


def clip(c: Column, lo: float | None = 0.0, hi: float | None = None) -> Column:
    """Numpy-like clip; NULL stays NULL and NaN stays NaN (greatest/least would drop them)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).when(F.isnan(c), c).otherwise(out)


def floor_at(c: Column, floor: float = 0.0) -> Column:
    """max(c, floor) keeping NULL/NaN."""
    return clip(c, floor, None)


def price_per_unit(price: Column, normalized: Column) -> Column:
    """Price / max(normalised quantity, 1e-6); NULL if either is missing."""
    ok = ~is_missing(price) & ~is_missing(normalized)
    return F.when(ok, price / F.greatest(normalized, F.lit(1e-6)))


def non_finite_flags(c: Column) -> list[Column]:
    """NaN, infinite, negative predicates."""
    return [F.isnan(c).alias("is_nan"), (F.abs(c) == F.lit(float("inf"))).alias("is_inf"), (c < 0).alias("is_negative")]


def range_label(lo: Column, hi: Column) -> Column:
    """F16: '[min, max]' with two decimals."""
    return F.format_string("[%.2f, %.2f]", lo, hi)


def split_title(name: Column) -> Column:
    """F18."""
    return F.concat(F.upper(name), F.lit(" METRICS"))


def md5_uniform(key: Column, seed: int, stream: int) -> Column:
    """Deterministic uniform in (0, 1) from md5 of (seed, stream, key): 52 bits of the hash."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(stream)), key.cast("string"))), 1, 13), 16, 10)
    return (h.cast("double") + 1.0) / (float(16 ** 13) + 1.0)


def gaussian_noise(key: Column, seed: int) -> Column:
    """Standard normal per key by Box-Muller on two md5 uniforms (same value on every rerun)."""
    import math

    u1, u2 = md5_uniform(key, seed, 1), md5_uniform(key, seed, 2)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


def noisy_prediction(pred: Column, key: Column, seed: int, sd: float = 0.001, floor: float = 0.01) -> Column:
    """Pred * (1 + N(0, sd)), floored at ``floor``; reproducible per key and seed."""
    return F.greatest(pred * (1.0 + sd * gaussian_noise(key, seed)), F.lit(floor))
