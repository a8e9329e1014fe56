"""Feature matrix, boosted-tree variants, SMAPE boosting, search, predictions.

The trees are those of ``hist``: second-order, with L1 and L2 penalties, on histograms, all variants or trials
in one fleet. The leaf-wise, depth-wise and symmetric variants have the configured parameters; the search draws
from the configured ranges.
"""

from __future__ import annotations

import math
import random
from dataclasses import replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import constants as C
from ...operators.profile import fill_missing, numeric_columns
from ...operators.splits import train_val_split
from .hist import HistModel, TreeParams, fit_fleet


def prepare_matrix(features: DataFrame, target: str = "price", key: str = "sample_id", split: bool = True,
                   exclude: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """Numeric features (P04), NULL/NaN -> 0 (P06), label = log1p(target) (M01), split (X01),
    assembled ``features`` vector. Rows without a usable target are dropped (P13)."""
    cols = [c for c in numeric_columns(features) if c not in (target, key) + tuple(exclude)]
    bools = [f.name for f in features.schema.fields if f.dataType.typeName() == "boolean"]
    x = features.select(key, target, *cols, *[F.col(b).cast("double").alias(b) for b in bools])
    cols = cols + bools
    x = fill_missing(x, 0.0, cols)
    x = x.where(F.col(target).isNotNull() & ~F.isnan(target)).withColumn("label", F.log1p(F.col(target)))
    if split:
        x = train_val_split(x, key)
    va = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    return va.transform(x), cols


TRIALS, TRIAL_PATIENCE = 50, 50  # search trials, and their rounds without improvement

# fixed values: the configured parameters of the three variants
VARIANTS = {
    "lightgbm": TreeParams("leaf", rate=0.05, max_depth=-1, leaves=31, alpha=0.1, lam=0.1, min_rows=20, row_share=0.8, row_every=5, column_share=0.8),
    "xgboost": TreeParams("depth", rate=0.05, max_depth=6, alpha=0.1, lam=0.1, min_weight=3.0, row_share=0.8, column_share=0.8),
    "catboost": TreeParams("symmetric", rate=0.05, max_depth=6, lam=3.0),
}
# fixed values: the search ranges; "log" is drawn log-uniformly
RANGES = {
    "lightgbm": {"leaves": (20, 200, "int"), "max_depth": (3, 15, "int"), "rate": (0.01, 0.3, "log"), "column_share": (0.4, 1.0, "float"), "row_share": (0.4, 1.0, "float"),
                 "row_every": (1, 10, "int"), "min_rows": (5, 100, "int"), "alpha": (1e-8, 10.0, "log"), "lam": (1e-8, 10.0, "log")},
    "xgboost": {"max_depth": (3, 12, "int"), "rate": (0.01, 0.3, "log"), "row_share": (0.4, 1.0, "float"), "column_share": (0.4, 1.0, "float"),
                "min_weight": (1, 50, "int"), "alpha": (1e-8, 10.0, "log"), "lam": (1e-8, 10.0, "log")},
}


def train_variants(matrix: DataFrame, columns: list[str], variants=("lightgbm", "xgboost", "catboost"), **over) -> dict:
    """All variants at once on the train split, each stopped after ``PATIENCE`` rounds
    without gain on validation and cut to its best round; metrics per model. A variant that fails fails the
    job: no model is filed under another's name."""
    unknown = set(variants) - set(VARIANTS)
    if unknown:
        raise ValueError(f"unknown variants: {sorted(unknown)}")
    fitted = fit_fleet(matrix, columns, [replace(VARIANTS[v], **over) for v in variants])
    out = {}
    for v, m in zip(variants, fitted):
        _, _, val, train = m.at_best()
        out[v] = {"model": m, "train_smape": train, "val_smape": val, "best_iteration": m.best_iteration, "rounds": len(m.history) - 1}
    return out


def predictions_long(models: dict, matrix: DataFrame, key: str = "sample_id") -> DataFrame:
    """One long table (model, split, sample_id, pred) of back-transformed predictions. The matrix is read once: a row
    has the predictions of all models before it becomes a row a model."""
    known = [(name, m) for name, m in sorted(models.items()) if hasattr(m, "transform")]  # unknown entries are skipped
    for i, (_, m) in enumerate(known):
        matrix = m.transform(matrix, f"_pred{i}")
    preds = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.expm1(f"_pred{i}").alias("pred")) for i, (name, _) in enumerate(known)]))
    rows = matrix.select("split", key, F.expm1("label").alias("y_true"), preds.alias("_p"))
    return rows.select("_p.model", "split", key, "_p.pred", "y_true")


def feature_importance(model: HistModel, spark) -> DataFrame:
    """Share of the gain per feature name (T01 sorts it)."""
    return spark.createDataFrame([(c, float(v)) for c, v in zip(model.columns, model.importance)], "feature string, importance double")


# ---- K05: boosting with the SMAPE objective -----------------------------------------------------
def smape_boost(matrix: DataFrame, columns: list[str], variant: str = "lightgbm", **over) -> HistModel:
    """A variant on the SMAPE gradient and hessian in log space, stopped by validation SMAPE. The mean
    without any tree is a candidate, so the model kept is never worse on validation than the constant."""
    return fit_fleet(matrix, columns, [replace(VARIANTS[variant], objective="smape", **over)])[0]


# ---- K09: random search ---------------------------------------------------------------------------
def draw_trials(variant: str, n_trials: int, seed: int = C.RANDOM_STATE) -> list[TreeParams]:
    """Seeded draws from the variant's ranges."""
    rng, out = random.Random(seed), []
    for _ in range(n_trials):
        drawn = {}
        for name, (low, high, kind) in RANGES[variant].items():
            drawn[name] = rng.randint(low, high) if kind == "int" else rng.uniform(low, high) if kind == "float" else math.exp(rng.uniform(math.log(low), math.log(high)))
        out.append(replace(VARIANTS[variant], patience=TRIAL_PATIENCE, **drawn))
    return out


def random_search(matrix: DataFrame, columns: list[str], variant: str = "lightgbm", n_trials: int = TRIALS, timeout_s: float | None = None,
                  seed: int = C.RANDOM_STATE) -> tuple[TreeParams, list[tuple[TreeParams, HistModel]]]:
    """All trials fitted together on the train split, scored by back-transformed SMAPE on validation at
    their best round. Returns the best trial's parameters over the variant's own, and every trial with its model.
    At the time limit the trials are scored as far as they came."""
    trials = draw_trials(variant, n_trials, seed)
    fitted = fit_fleet(matrix, columns, trials, timeout_s=timeout_s)
    results = list(zip(trials, fitted))
    best = min(results, key=lambda r: r[1].at_best()[2])[0]
    return replace(best, patience=VARIANTS[variant].patience), results
