"""Ridge and elastic net with cross-validation from sufficient statistics.

One aggregate (grouped by fold) gives, per fold, n, sum x, sum y, X'X and X'y (d x d, d = number of
inputs: small for meta learners). Training statistics of a fold are "all minus that fold". Every
(alpha, fold) model is then solved exactly on the driver with the same centred formulation as the
usual estimators (intercept from the means): ridge by a linear solve, elastic net by coordinate descent
on the Gram matrix. Validation errors of all candidates come from one more pass whose per-row
prediction is a ``when(fold = k, ...)`` expression - no join, no per-fit job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ... import constants as C


@dataclass
class LinearModel:
    coef: np.ndarray
    intercept: float
    inputs: list[str]
    params: dict = field(default_factory=dict)

    def expr(self) -> Column:
        e = F.lit(float(self.intercept))
        for c, w in zip(self.inputs, self.coef):
            e = e + F.col(f"`{c}`") * float(w)
        return e

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expr())

    def to_dict(self) -> dict:
        return {"coef": [float(x) for x in self.coef], "intercept": float(self.intercept), "inputs": self.inputs,
                "params": self.params}

    @staticmethod
    def from_dict(d: dict) -> "LinearModel":
        return LinearModel(np.asarray(d["coef"], dtype=float), float(d["intercept"]), list(d["inputs"]), d.get("params", {}))


class Stats(dict):
    """{fold: (n, sx, sy, XtX, Xty, syy)} of inputs and label shifted by their global means
    (``shift_x``, ``shift_y``): sums of products of centred values do not cancel catastrophically
    when the inputs are large numbers summed over billions of rows."""

    shift_x: np.ndarray
    shift_y: float

    def original(self, w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        """(w, b) of a model fitted in shifted space -> intercept in original units."""
        return w, float(b + self.shift_y - self.shift_x @ w)


def fold_stats(df: DataFrame, inputs: list[str], label: str, fold_col: str | None = "fold") -> Stats:
    """Per-fold sufficient statistics from two aggregates (means, then centred sums)."""
    d = len(inputs)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(inputs)],
                   F.avg(F.col(label).cast("double")).alias("my")).collect()[0]
    mx = np.array([means[f"m{i}"] or 0.0 for i in range(d)])
    my = float(means["my"] or 0.0)
    x = [F.col(f"`{c}`").cast("double") - float(mx[i]) for i, c in enumerate(inputs)]
    y = F.col(label).cast("double") - my
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x[i]).alias(f"sx{i}") for i in range(d)]
    aggs += [F.sum(x[i] * y).alias(f"xy{i}") for i in range(d)]
    aggs += [F.sum(x[i] * x[j]).alias(f"xx{i}_{j}") for i in range(d) for j in range(i, d)]
    g = df.groupBy(fold_col) if fold_col else df.groupBy()
    out = Stats()
    out.shift_x, out.shift_y = mx, my
    for r in g.agg(*aggs).collect():  # one row per fold
        xx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                xx[i, j] = xx[j, i] = r[f"xx{i}_{j}"] or 0.0
        key = r[fold_col] if fold_col else -1
        out[key] = (r["n"], np.array([r[f"sx{i}"] or 0.0 for i in range(d)]), r["sy"] or 0.0, xx,
                    np.array([r[f"xy{i}"] or 0.0 for i in range(d)]), r["syy"] or 0.0)
    return out


def _sum_stats(parts):
    n = sum(p[0] for p in parts)
    return (n, sum(p[1] for p in parts), sum(p[2] for p in parts), sum(p[3] for p in parts), sum(p[4] for p in parts),
            sum(p[5] for p in parts))


def _centred(stats):
    n, sx, sy, xx, xy, _ = stats
    mx, my = sx / n, sy / n
    g = xx - n * np.outer(mx, mx)
    b = xy - n * mx * my
    return n, mx, my, g, b


def solve_ridge(stats, alpha: float) -> tuple[np.ndarray, float]:
    """min ||y - Xw - b||^2 + alpha ||w||^2 (intercept not penalised)."""
    n, mx, my, g, b = _centred(stats)
    w = np.linalg.solve(g + alpha * np.eye(len(b)), b)
    return w, float(my - mx @ w)


def solve_enet(stats, alpha: float, l1_ratio: float, max_iter: int = 5000, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """min 1/(2n) ||y - Xw - b||^2 + alpha l1 ||w||_1 + alpha (1 - l1) / 2 ||w||^2, by cyclic coordinate
    descent on the Gram matrix (stopping rule: largest coefficient change below tol * largest coefficient)."""
    n, mx, my, g, b = _centred(stats)
    d = len(b)
    w = np.zeros(d)
    l1 = alpha * l1_ratio * n
    l2 = alpha * (1.0 - l1_ratio) * n
    for _ in range(max_iter):
        w_max = d_max = 0.0
        for j in range(d):
            if g[j, j] == 0:
                continue
            old = w[j]
            rho = b[j] - g[j] @ w + g[j, j] * w[j]
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / (g[j, j] + l2)
            d_max = max(d_max, abs(w[j] - old))
            w_max = max(w_max, abs(w[j]))
        if w_max == 0.0 or d_max / w_max < tol:
            break
    return w, float(my - mx @ w)


def logspace(lo: float, hi: float, num: int) -> list[float]:
    return [float(x) for x in np.logspace(lo, hi, num)]


def _cv_errors(df: DataFrame, inputs: list[str], label: str, fold_col: str, models: dict) -> dict:
    """Mean absolute validation error of every candidate: models[(cand, fold)] = (w, b). One pass."""
    cands = sorted({c for c, _ in models})
    folds = sorted({f for _, f in models})
    y = F.col(label).cast("double")
    aggs = []
    for ci, c in enumerate(cands):
        pred = None
        for f in folds:
            w, b = models[(c, f)]
            e = F.lit(float(b))
            for name, wk in zip(inputs, w):
                e = e + F.col(f"`{name}`") * float(wk)
            pred = F.when(F.col(fold_col) == f, e) if pred is None else pred.when(F.col(fold_col) == f, e)
        aggs.append(F.sum(F.abs(y - pred)).alias(f"e{ci}"))
    rows = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n"), *aggs).collect()
    out = {}
    for ci, c in enumerate(cands):
        # sklearn-style: mean over folds of the per-fold MAE
        out[c] = float(np.mean([r[f"e{ci}"] / r["n"] for r in rows]))
    return out


def ridge_cv(df: DataFrame, inputs: list[str], label: str, fold_col: str = "fold", alphas: list[float] | None = None) -> LinearModel:
    """Alpha by lowest mean CV MAE over the folds, then refit on all rows."""
    alphas = alphas or logspace(*C.RIDGE_ALPHA_RANGE)
    st = fold_stats(df, inputs, label, fold_col)
    total = _sum_stats(list(st.values()))
    models = {}
    for a in alphas:
        for f in st:
            train = _sum_stats([v for k, v in st.items() if k != f])
            models[(a, f)] = st.original(*solve_ridge(train, a))
    err = _cv_errors(df, inputs, label, fold_col, models)
    best = min(alphas, key=lambda a: (err[a], a))
    w, b = st.original(*solve_ridge(total, best))
    return LinearModel(w, b, inputs, {"alpha": best, "cv_mae": err[best]})


def enet_cv(df: DataFrame, inputs: list[str], label: str, fold_col: str = "fold", alphas: list[float] | None = None,
            l1_ratios: list[float] | None = None) -> LinearModel:
    """(alpha, l1_ratio) by lowest mean CV squared error, then refit on all rows."""
    alphas = alphas or logspace(*C.ENET_ALPHA_RANGE)
    l1_ratios = l1_ratios or C.ENET_L1_RATIOS
    st = fold_stats(df, inputs, label, fold_col)
    total = _sum_stats(list(st.values()))
    cands = [(a, r) for r in l1_ratios for a in alphas]
    mse = {}
    for cand in cands:
        errs = []
        for f in st:
            train = _sum_stats([v for k, v in st.items() if k != f])
            w, b = solve_enet(train, *cand)
            n, sx, sy, xx, xy, syy = st[f]
            # held-out squared error from the fold's own statistics: sum (y - xw - b)^2
            sse = syy - 2 * (w @ xy + b * sy) + w @ xx @ w + 2 * b * (w @ sx) + n * b * b
            errs.append(sse / n)
        mse[cand] = float(np.mean(errs))
    best = min(cands, key=lambda c: (mse[c], c[0], c[1]))
    w, b = st.original(*solve_enet(total, *best))
    return LinearModel(w, b, inputs, {"alpha": best[0], "l1_ratio": best[1], "cv_mse": mse[best]})


def out_of_fold(df: DataFrame, inputs: list[str], label: str, solver, fold_col: str = "fold", out: str = "oof") -> DataFrame:
    """Every row predicted by the model fitted without its fold (one pass; weights per fold)."""
    st = fold_stats(df, inputs, label, fold_col)
    pred = None
    for f in sorted(st):
        train = _sum_stats([v for k, v in st.items() if k != f])
        w, b = st.original(*solver(train))
        e = F.lit(float(b))
        for name, wk in zip(inputs, w):
            e = e + F.col(f"`{name}`") * float(wk)
        pred = F.when(F.col(fold_col) == f, e) if pred is None else pred.when(F.col(fold_col) == f, e)
    return df.withColumn(out, pred)


def ridge_fit(df: DataFrame, inputs: list[str], label: str, alpha: float = 1.0) -> LinearModel:
    """K21 building block: plain ridge on all rows (one aggregate)."""
    st = fold_stats(df, inputs, label, None)
    w, b = st.original(*solve_ridge(st[-1], alpha))
    return LinearModel(w, b, inputs, {"alpha": alpha})
