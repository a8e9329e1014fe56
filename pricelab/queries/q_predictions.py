"""Registered queries: the prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import predictions as PR
from ..operators import sets as S
from ..oracle.fixtures import with_fixtures
from ..registry import r6, register, rnd_sql, round_py, rounded
from ..session import table
from ..sources.derived import MODEL_OFFSETS, predictions

MODELS = sorted(m for m, _ in MODEL_OFFSETS)


@register("j03_stack_wide", with_fixtures(
    "select sample_id, " + ", ".join(f"max(case when model = '{m}' then pred end) as {m}" for m in MODELS) +
    ", " + " and ".join(f"max(case when model = '{m}' then pred end) is not null" for m in MODELS) +
    " as complete from preds group by sample_id"))
def j03_stack_wide(spark, sf_dir):
    """One column per model in sorted order (pivot with a fixed value list)."""
    return PR.stack_wide(predictions(spark, sf_dir), MODELS)


@register("j04_attach_targets", with_fixtures("""
select p.sample_id, p.model, p.pred, o.o_custkey from preds p join orders o on cast(o.o_orderkey as varchar) = p.sample_id"""))
def j04_attach_targets(spark, sf_dir):
    """Predictions joined to their ids, after checking both anti joins are empty."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"), "o_custkey")
    return S.attach_targets(predictions(spark, sf_dir).select("sample_id", "model", "pred"), ids)


@register("a20_average_predictions", with_fixtures(
    "select sample_id, " + rnd_sql("avg(pred)", 8) + " as pred, count(*) as n_preds from preds group by sample_id"))
def a20_average_predictions(spark, sf_dir):
    """Average of the repeated predictions per id. (Means of 4 values with 5 decimals have exact
    decimal ties at the 7th digit, so this one is compared at 8 digits.)"""
    return rounded(PR.average_predictions(predictions(spark, sf_dir)), 8)


WEIGHTS_SQL = """, sm as (select model, 100 * avg(abs(pred - y_true) / ((abs(y_true) + abs(pred)) / 2.0 + 1e-10)) as smape from preds group by model),
w as (select model, smape, 1.0 / smape as raw_weight, abs(1.0 / smape) / sum(abs(1.0 / smape)) over () as weight from sm)
"""


@register("a22_weight_normalisation", with_fixtures(WEIGHTS_SQL + f"""
select model, {r6('smape')} as smape, {r6('raw_weight')} as raw_weight, {r6('weight')} as weight from w"""))
def a22_weight_normalisation(spark, sf_dir):
    """Inverse-SMAPE weights, |w| / sum |w|."""
    return rounded(PR.inverse_smape_weights(predictions(spark, sf_dir)))


_W12 = {m: "(select " + rnd_sql("weight", 12) + f" from w where model = '{m}')" for m in MODELS}


@register("a21_weighted_combination", with_fixtures(WEIGHTS_SQL + ", wide as (select sample_id, " + ", ".join(
    f"max(case when model = '{m}' then pred end) as {m}" for m in MODELS) + " from preds group by sample_id)\n"
    + "select sample_id, " + rnd_sql(" + ".join(f"{m} * {_W12[m]}" for m in MODELS), 6) + " as pred from wide"))
def a21_weighted_combination(spark, sf_dir):
    """Weighted combination per id with inverse-SMAPE weights (A22), evaluated on the pivoted row
    in sorted model order so that the sum is the same on every run (weights rounded to 12 decimals)."""
    p = predictions(spark, sf_dir)
    w = {r["model"]: round_py(r["weight"], 12) for r in PR.inverse_smape_weights(p).collect()}  # one row per model
    wide = PR.stack_wide(p, MODELS)
    return rounded(wide.select("sample_id", PR.weighted_expr(MODELS, [w[m] for m in MODELS]).alias("pred")))


@register("a21_weighted_combination_long", with_fixtures(WEIGHTS_SQL + "select sample_id, " + rnd_sql("sum(weight * pred)", 3)
                                                         + " as pred from preds join w using (model) group by sample_id"))
def a21_weighted_combination_long(spark, sf_dir):
    """A21 on the long table: weights broadcast (one row per model), sum per id (3 decimals: the order of the sum is free)."""
    p = predictions(spark, sf_dir)
    return rounded(PR.weighted_combination(p, PR.inverse_smape_weights(p)), 3)


@register("u05_union_predictions", with_fixtures("select sample_id, model, y_true, pred from preds"))
def u05_union_predictions(spark, sf_dir):
    """Per-model prediction tables unioned back into the long table."""
    p = predictions(spark, sf_dir)
    parts = [p.where(F.col("model") == m) for m in MODELS]
    return S.union_predictions(*parts)


@register("k15_optimised_weights")
def k15_optimised_weights(spark, sf_dir):
    """Nelder-Mead weights minimising the SMAPE of the weighted average (one distributed
    aggregate per simplex step, several candidates per job)."""
    p = predictions(spark, sf_dir)
    wide = PR.cache_for_iterations(PR.require_complete(PR.stack_wide(p, MODELS, extra=("y_true",))), ["y_true", *MODELS])
    w = PR.optimise_weights(wide, MODELS, "y_true")
    s = PR.smape_of_weights(wide, MODELS, "y_true", [w])[0]
    wide.unpersist()
    rows = [(m, float(x), s) for m, x in zip(MODELS, w)]
    return spark.createDataFrame(rows, "model string, weight double, smape double")


@register("k14_pattern_search_weights")
def k14_pattern_search_weights(spark, sf_dir):
    """K14 with few jobs: simplex-lattice + pairwise pattern search of the level-2 weights (each step one
    aggregate over every row); compared with equal weights."""
    p = predictions(spark, sf_dir)
    wide = PR.cache_for_iterations(PR.require_complete(PR.stack_wide(p, MODELS, extra=("y_true",))), ["y_true", *MODELS])
    w = PR.pattern_search_weights(wide, MODELS, "y_true")
    s_w, s_eq = PR.smape_of_weights(wide, MODELS, "y_true", [w, [1.0] * len(MODELS)])
    wide.unpersist()
    rows = [(m, float(x), s_w, s_eq) for m, x in zip(MODELS, w)]
    return spark.createDataFrame(rows, "model string, weight double, smape double, smape_equal_weights double")
