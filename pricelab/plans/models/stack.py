"""Two-level stacking on the wide prediction table.

Level 1 (meta learners on the sorted model columns): ridge CV and elastic-net CV from sufficient
statistics (``linear``), and a shallow boosted-tree learner with K-fold out-of-fold predictions (``hist``: the fold
models and the final one grow together).
Level 2: Nelder-Mead weights of the three meta predictions on validation (each evaluation one
aggregate), then isotonic calibration (``isotonic``: blocks pooled as tables), floored at 0.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ... import constants as C
from ...operators.predictions import cache_for_iterations, optimise_weights, smape_of_weights, weighted_expr
from ...operators.windows import shuffled_folds
from . import linear as L
from .hist import HistModel, TreeParams, fit_fleet
from .isotonic import IsotonicModel, fit_isotonic

META = ["ridge", "elasticnet", "lgbm"]


# fixed values: the configured parameters of the learner
SHALLOW = TreeParams("depth", rate=0.05, max_depth=4, alpha=0.1, lam=0.1, min_rows=50, row_share=0.8, column_share=0.8, rounds=100, patience=20)


def shallow_gbt_oof(train: DataFrame, val: DataFrame, models: list[str], target: str, key: str = "sample_id",
                    fold_col: str = "fold", n_folds: int = C.N_FOLDS):
    """Out-of-fold train predictions, fold-averaged validation predictions, final model.

    Each fold model trains on the other folds and stops early on its own fold. These models and the final one, on all
    training rows, grow together: a job takes all of them a level further."""
    rows = train.select(*models, F.col(target).cast("double").alias("_y"), F.col(fold_col).alias("_fold"), F.lit("train").alias("_split"))
    *by_fold, final = fit_fleet(rows, list(models), [replace(SHALLOW, fold=k) for k in range(n_folds)] + [SHALLOW], "_y", "_split", fold="_fold")
    oof = reduce(DataFrame.unionByName, [m.transform(train.where(F.col(fold_col) == k), "lgbm").select(key, "lgbm") for k, m in enumerate(by_fold)])
    # Fold models averaged per validation row
    val_pred = val
    for k, m in enumerate(by_fold):
        val_pred = m.transform(val_pred, f"_p{k}")
    val_pred = val_pred.select(key, (sum(F.col(f"_p{k}") for k in range(n_folds)) / n_folds).alias("lgbm"))
    return oof, val_pred, final


@dataclass
class StackingEnsemble:
    """K17 / K18 with the fitted parts; ``save``/``load`` is S10."""

    models: list[str] = field(default_factory=list)
    ridge: L.LinearModel | None = None
    enet: L.LinearModel | None = None
    lgbm: HistModel | None = None
    weights: np.ndarray | None = None
    isotonic: IsotonicModel | None = None
    val_smape: float | None = None

    # ---- K17 --------------------------------------------------------------------------------------
    def fit(self, train: DataFrame, val: DataFrame, target: str = "y_true", key: str = "sample_id",
            use_isotonic: bool = True, optimize_weights: bool = True, n_folds: int = C.N_FOLDS) -> "StackingEnsemble":
        self.models = sorted(self.models) if self.models else sorted(
            c for c in train.columns if c not in (key, target, "split", "complete", "fold"))
        folded = shuffled_folds(train, key, n_folds)
        tr = cache_for_iterations(folded, folded.columns)
        self.ridge = L.ridge_cv(tr, self.models, target, "fold")
        self.enet = L.enet_cv(tr, self.models, target, "fold")
        _oof, val_lgbm, self.lgbm = shallow_gbt_oof(tr, val, self.models, target, key, "fold", n_folds)
        meta_val = cache_for_iterations(
            val.select(key, target, self.ridge.expr().alias("ridge"), self.enet.expr().alias("elasticnet")).join(val_lgbm, key),
            [key, target, *META])
        if optimize_weights:
            self.weights = optimise_weights(meta_val, META, target)
        else:
            self.weights = np.full(len(META), 1.0 / len(META))
        if use_isotonic:
            cal = meta_val.select(weighted_expr(META, self.weights).alias("_wp"), F.col(target).alias("_y"))
            self.isotonic = fit_isotonic(cal, "_wp", "_y")
        self.val_smape = smape_of_weights(self.predict(val, out="_final"), ["_final"], target, [np.array([1.0])])[0]
        meta_val.unpersist()
        tr.unpersist()
        return self

    # ---- K18 --------------------------------------------------------------------------------------
    def _meta(self, wide: DataFrame) -> DataFrame:
        x = wide.withColumn("ridge", self.ridge.expr()).withColumn("elasticnet", self.enet.expr())
        return self.lgbm.transform(x, "lgbm")

    def _final(self, meta: DataFrame) -> DataFrame:
        x = meta.withColumn("_wp", weighted_expr(META, self.weights))
        if self.isotonic is not None:
            x = self.isotonic.transform(x, "_wp", "_final").withColumn("_final", F.greatest(F.col("_final"), F.lit(0.0)))
        else:
            x = x.withColumn("_final", F.greatest(F.col("_wp"), F.lit(0.0)))
        return x

    def predict(self, wide: DataFrame, return_intermediate: bool = False, out: str = "pred") -> DataFrame:
        if self.ridge is None or self.weights is None:
            raise ValueError("Ensemble not fitted. Call fit() first.")
        x = self._final(self._meta(wide)).withColumnRenamed("_final", out)
        if not return_intermediate:
            x = x.drop("ridge", "elasticnet", "lgbm", "_wp")
        return x

    # ---- S10 --------------------------------------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        state = {"models": self.models, "ridge": self.ridge.to_dict(), "enet": self.enet.to_dict(),
                 "weights": [float(w) for w in self.weights], "val_smape": self.val_smape,
                 "isotonic": self.isotonic is not None}
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").json(f"{path}/state")
        self.lgbm.save(spark, f"{path}/lgbm")
        if self.isotonic is not None:
            self.isotonic.save(f"{path}/isotonic")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "StackingEnsemble":
        st = json.loads(spark.read.json(f"{path}/state").collect()[0]["state"])
        e = StackingEnsemble(st["models"], L.LinearModel.from_dict(st["ridge"]), L.LinearModel.from_dict(st["enet"]),
                             HistModel.load(spark, f"{path}/lgbm"), np.asarray(st["weights"]),
                             IsotonicModel.load(spark, f"{path}/isotonic") if st["isotonic"] else None, st["val_smape"])
        return e


def train_ensemble(wide: DataFrame, models: list[str], target: str = "y_true", key: str = "sample_id",
                   split_col: str = "split") -> tuple[DataFrame, StackingEnsemble, np.ndarray]:
    """Base scores, simple weighted average (K15), stacking, comparison.

    Returns (comparison table, fitted ensemble, simple-average weights). Test rows are those whose
    split is neither train nor validation."""
    train = wide.where(F.col(split_col) == "train")
    val = cache_for_iterations(wide.where(F.col(split_col) == "validation"), [c for c in wide.columns])
    base = smape_of_weights(val, models, target, [np.eye(len(models))[i] for i in range(len(models))])
    w_avg = optimise_weights(val, models, target)
    s_avg = smape_of_weights(val, models, target, [w_avg])[0]
    ens = StackingEnsemble(models).fit(train, val, target, key)
    rows = [(m, float(s)) for m, s in zip(models, base)] + [("weighted_average", float(s_avg)), ("stacking", float(ens.val_smape))]
    spark = wide.sparkSession
    comp = spark.createDataFrame(rows, "model string, val_smape double")
    comp = comp.withColumn("improvement_over_average", F.lit(float(s_avg)) - F.col("val_smape"))
    val.unpersist()
    return comp, ens, w_avg
