"""Registered queries: the feature projection under Structured Streaming, and R05 id sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tfidf as T
from ..oracle.sqlfeatures import features_select
from ..registry import register
from ..sources.derived import catalog
from ..streaming.features import stream_features


@register("st01_streaming_features", "select * from (" + features_select("documents", id_col="doc_id", text_col="text") + ")")
def st01_streaming_features(spark, sf_dir):
    """V07 on a file stream of ``documents`` (availableNow trigger, Parquet sink with checkpoint)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").schema
    return stream_features(spark, sf_dir, schema, "text", "doc_id", glob="documents.parquet")


def _r05_sql() -> str:
    from ..oracle.fixtures import with_fixtures
    from ..oracle.sqlfeatures import q
    from .q_tfidf import _vocab_sql

    return with_fixtures(_vocab_sql("catalog") + f""", tok as (select sample_id,
    regexp_extract_all(strip_accents(lower(coalesce(catalog_content, ''))), {q(T.TOKEN_RX)}) as t from catalog),
pos as (select sample_id, t[i] as term, i from (select sample_id, t, generate_subscripts(t, 1) as i from tok) where i <= 128),
ids as (select p.sample_id, list(coalesce(v.term_index + 2, 1) order by p.i) as ids
        from pos p left join vocab v on v.term = p.term group by p.sample_id),
full_ as (select c.sample_id, coalesce(ids.ids, []) as ids from catalog c left join ids on ids.sample_id = c.sample_id)
select sample_id, 128 as length, cast(len(ids) as integer) as n_tokens,
  array_to_string(list_concat(ids, list_transform(range(128 - len(ids)), lambda x: 0)), ' ') as input_ids from full_""")


@register("r05_id_sequences", _r05_sql())
def r05_id_sequences(spark, sf_dir):
    """128-long id sequences and attention masks through the fitted vocabulary."""
    c = catalog(spark, sf_dir)
    s = T.id_sequences(T.fit(c), c)
    return s.select("sample_id", F.size("input_ids").alias("length"), F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b).alias("n_tokens"),
                    F.array_join("input_ids", " ").alias("input_ids"))


@register("e1_feature_stage")
def e1_feature_stage(spark, sf_dir):
    """Train split of the catalog -> features + TF-IDF (fitted on train) -> Parquet store ->
    sample -> audit; returns the audit report with the alignment issues appended."""
    from ..operators.splits import train_val_split
    from ..plans.stages import feature_stage
    from ..session import scratch_path

    c = train_val_split(catalog(spark, sf_dir))
    train = c.where(F.col("split") == "train").drop("split")
    test = c.where(F.col("split") == "validation").drop("split", "price")
    res = feature_stage(spark, train, test, scratch_path(spark, "feature-stage"))
    align = res.alignment.select(F.col("issue").alias("check"), F.col("column").alias("item"), F.lit(None).cast("double").alias("value"))
    return res.audit.unionByName(align)


@register("e2_ensemble_stage")
def e2_ensemble_stage(spark, sf_dir):
    """Prediction store -> stacking ensemble -> test submission -> validation -> timestamped output;
    returns the validation report (with the ensemble's validation SMAPE per compared model)."""
    from ..operators.splits import train_val_test_split
    from ..plans.stages import ensemble_stage
    from ..session import scratch_path, table
    from ..sources import store as ST
    from ..sources.derived import predictions

    base = scratch_path(spark, "ensemble-stage")
    ST.save_predictions(train_val_test_split(predictions(spark, sf_dir)), f"{base}/store")
    o = train_val_test_split(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id")))
    res = ensemble_stage(spark, f"{base}/store", o.where(F.col("split") == "test").select("sample_id"), base)
    comp = res.comparison.select(F.concat(F.lit("val_smape:"), F.col("model")).alias("check"), F.lit("info").alias("severity"),
                                 F.lit(0).cast("long").alias("n"), F.lit(True).alias("ok"))
    return res.report.unionByName(comp)
