"""The two end-to-end stages as compositions of the operators (no new logic).

E1 feature stage: raw train/test tables -> 19 features + TF-IDF fitted on train (V05) -> Parquet
feature store (S03) -> 100-row sample (S13) -> audit (Q05) and column alignment (J09).
E2 ensemble stage: prediction store (S06) -> wide table per split (J03) -> base scores, weighted
average and stacking (K19) -> test predictions -> submission (Q02) -> validation (Q01/Q03) ->
timestamped + latest output (S15).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import predictions as PR
from ..operators import profile as P
from ..operators import tfidf as T
from ..sources import store as ST
from . import submission as SUB
from .features import features_with_tfidf


@dataclass
class FeatureStageResult:
    train_path: str
    test_path: str
    sample_path: str
    vocabulary_path: str
    audit: DataFrame
    alignment: DataFrame


def feature_stage(spark: SparkSession, train: DataFrame, test: DataFrame, out_dir: str,
                  text_col: str = "catalog_content", id_col: str = "sample_id") -> FeatureStageResult:
    """E1. ``train`` carries ``price``; ``test`` does not. Everything is written under ``out_dir``."""
    model = T.fit(train, text_col, id_col)
    vocab_path = f"{out_dir}/vocabulary"
    model.save(vocab_path)
    train_f = features_with_tfidf(train, model, text_col, id_col, keep=["price"])
    test_f = features_with_tfidf(test, model, text_col, id_col)
    train_path, test_path = f"{out_dir}/train_features", f"{out_dir}/test_features"
    ST.write_parquet(train_f, train_path)
    ST.write_parquet(test_f, test_path)
    stored_train = ST.read_parquet(spark, train_path)
    sample_path = f"{out_dir}/train_features_sample"
    ST.write_sample(stored_train, sample_path, id_col)
    audit = P.feature_audit(stored_train.drop(id_col))
    alignment = P.column_alignment(stored_train, ST.read_parquet(spark, test_path))
    return FeatureStageResult(train_path, test_path, sample_path, vocab_path, audit, alignment)


@dataclass
class EnsembleStageResult:
    comparison: DataFrame
    report: DataFrame
    passed: bool
    stamped_path: str
    latest_path: str


def ensemble_stage(spark: SparkSession, store_path: str, expected_ids: DataFrame, out_dir: str,
                   models: list[str] | None = None, target: str = "y_true", key: str = "sample_id") -> EnsembleStageResult:
    """E2 on a prediction store partitioned by (model, split) with splits train / validation / test."""
    preds = ST.load_predictions(spark, store_path)
    models = sorted(models or ST.partition_values(spark, store_path, "model"))
    wide = PR.require_complete(PR.stack_wide(preds, models, key=key, extra=(target, "split")))
    from .models.stack import train_ensemble

    wide = PR.cache_for_iterations(wide, wide.columns)
    comparison, ens, _w = train_ensemble(wide, models, target, key)
    test_pred = ens.predict(wide.where(F.col("split") == "test"))
    sub = SUB.build_submission(test_pred, key, "pred")
    report = SUB.validation_report(sub, expected_ids, key, size_limit=SUB.SIZE_LIMIT_BYTES)
    ok = SUB.passed(report)
    stamped, latest = ST.write_timestamped(sub, f"{out_dir}/submissions")
    comparison = spark.createDataFrame(comparison.collect(), comparison.schema)  # one row per model
    wide.unpersist()
    return EnsembleStageResult(comparison, report, ok, stamped, latest)
