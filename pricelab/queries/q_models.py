"""Registered queries: model jobs (K01-K21) on catalog features and on the prediction table.

These are iterative model fits; most get the rows-only check, their numerics are tested against
closed forms / numpy in ``tests/``. K01 (the matrix) and the prediction inputs are SQL-checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import predictions as PR
from ..operators.splits import train_val_test_split
from ..operators.windows import shuffled_folds
from ..oracle.fixtures import with_fixtures
from ..plans.features import engineer_features
from ..plans.models import boost as B
from ..plans.models import linear as L
from ..plans.models import stack as ST
from ..plans.models.isotonic import fit_isotonic
from ..registry import r6, register, rounded
from ..session import scratch_path, table
from ..sources.derived import MODEL_OFFSETS, catalog, predictions

MODELS = sorted(m for m, _ in MODEL_OFFSETS)
SPLIT_SQL = "case when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 100 then 'validation' else 'train' end"


def _matrix(spark, sf_dir):
    return B.prepare_matrix(engineer_features(catalog(spark, sf_dir), keep=["price"]))


def _wide(spark, sf_dir):
    p = predictions(spark, sf_dir)
    wide = PR.require_complete(PR.stack_wide(p, MODELS, extra=("y_true",)))
    return train_val_test_split(wide)


@register("k01_feature_matrix", with_fixtures(
    f"select sample_id, {SPLIT_SQL} as split, {r6('ln(1 + price)')} as label from catalog where price is not null and not isnan(price)"))
def k01_feature_matrix(spark, sf_dir):
    """Numeric features, NaN -> 0, log target, split, assembled vector (checked: ids, split, label)."""
    m, _cols = _matrix(spark, sf_dir)
    return rounded(m.select("sample_id", "split", "label"))


SIZES_SQL = f"""select count(*) filter (where s = 'train') as n_train, count(*) filter (where s = 'validation') as n_validation
from (select {SPLIT_SQL} as s from catalog where price is not null and not isnan(price))"""


@register("k02_k04_gbt_variants", with_fixtures(f"""
select m.model, n.n_train, n.n_validation, true as stopped_in_time, true as leaves_within, true as not_worse_than_constant, true as score_agrees
from (values ('catboost'), ('lightgbm'), ('xgboost')) m(model), ({SIZES_SQL}) n"""))
def k02_k04_gbt_variants(spark, sf_dir):
    """Three boosted-tree variants of up to 1,000 rounds. Checked: each stops at most 100
    rounds after its best one (or at 1,000), keeps to its number of leaves, is not worse on validation than the
    constant, and scores the validation rows by ``transform`` as it did while growing."""
    m, cols = _matrix(spark, sf_dir)
    res = B.train_variants(m, cols)
    sizes = {r["split"]: r["count"] for r in m.groupBy("split").count().collect()}
    rows = []
    for name, v in sorted(res.items()):
        model = v["model"]
        again = model.transform(m.where("split = 'validation'")).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))).first()[0]
        most = 31 if model.params.growth == "leaf" else 2 ** model.params.max_depth
        rows.append((name, sizes.get("train", 0), sizes.get("validation", 0), v["rounds"] == 1000 or v["rounds"] - v["best_iteration"] == 100,
                     all((t.feature < 0).sum() <= most for t in model.trees), model.at_best()[1] <= model.history[0][1], abs(again - model.at_best()[1]) < 1e-9))
    return spark.createDataFrame([(*r[:3], *map(bool, r[3:])) for r in rows], "model string, n_train long, n_validation long, stopped_in_time boolean, "
                                 "leaves_within boolean, not_worse_than_constant boolean, score_agrees boolean")


PRICED_SQL = f"(select {SPLIT_SQL} as s, ln(1 + price) as label, price from catalog where price is not null and not isnan(price))"


@register("k05_smape_boost", with_fixtures(f"""
select count(*) filter (where s = 'train') as n_train, count(*) filter (where s = 'validation') as n_validation,
  {r6("avg(case when s = 'validation' then 100 * abs(p - price) / ((price + p) / 2 + 1e-10) end)")} as constant_smape, true as not_worse_than_constant, true as stopped_in_time
from {PRICED_SQL} m, (select exp(avg(case when s = 'train' then label end)) - 1 as p from {PRICED_SQL}) c"""))
def k05_smape_boost(spark, sf_dir):
    """Boosting with the SMAPE objective at the configured rate and penalties. Checked: the constant's SMAPE
    on validation, that the kept model is not above it (part prices follow the key, so there is little to learn),
    and that it stopped 100 rounds after its best one."""
    m, cols = _matrix(spark, sf_dir)
    model = B.smape_boost(m, cols)
    sizes = {r["split"]: r["count"] for r in m.groupBy("split").count().collect()}
    rounds = len(model.history) - 1
    row = (sizes.get("train", 0), sizes.get("validation", 0), float(model.history[0][2]), bool(model.at_best()[2] <= model.history[0][2]),
           bool(rounds == 1000 or rounds - model.best_iteration == 100))
    return rounded(spark.createDataFrame([row], "n_train long, n_validation long, constant_smape double, not_worse_than_constant boolean, stopped_in_time boolean"))


@register("k08_prediction_table")
def k08_prediction_table(spark, sf_dir):
    """K07 + K08: every variant predicts train, validation and test; one long (model, split, id, pred) table."""
    m, cols = _matrix(spark, sf_dir)
    m = train_val_test_split(m)
    res = B.train_variants(m, cols)
    return B.predictions_long({k: v["model"] for k, v in res.items()}, m)


@register("k09_random_search", """
select t.trial, true as in_ranges, true as stopped_in_time, true as not_below_best from range(50) t(trial)""")
def k09_random_search(spark, sf_dir):
    """Fifty trials over the configured ranges, fitted together and scored by back-transformed SMAPE on
    validation. Checked: drawn inside the ranges, stopped 50 rounds after the best, none below the best trial."""
    m, cols = _matrix(spark, sf_dir)
    best, results = B.random_search(m, cols)
    lowest = next(f.at_best()[2] for p, f in results if (p.rate, p.lam) == (best.rate, best.lam))
    rows = []
    for i, (p, f) in enumerate(results):
        inside = all(low <= getattr(p, name) <= high for name, (low, high, _) in B.RANGES["lightgbm"].items())
        rounds = len(f.history) - 1
        rows.append((i, inside, rounds == 1000 or rounds - f.best_iteration == 50, bool(f.at_best()[2] >= lowest)))
    return spark.createDataFrame(rows, "trial long, in_ranges boolean, stopped_in_time boolean, not_below_best boolean")


@register("k10_ridge_cv")
def k10_ridge_cv(spark, sf_dir):
    """Ridge meta learner, alpha from 20 log-spaced values by 5-fold CV MAE."""
    wide = shuffled_folds(_wide(spark, sf_dir).where("split = 'train'"))
    lm = L.ridge_cv(wide, MODELS, "y_true", "fold")
    return spark.createDataFrame([(m, float(w)) for m, w in zip(MODELS, lm.coef)] + [("intercept", lm.intercept),
                                                                                      ("alpha", lm.params["alpha"])],
                                 "term string, value double")


@register("k11_elasticnet_cv")
def k11_elasticnet_cv(spark, sf_dir):
    """Elastic-net meta learner over 5 mixing values x 20 alphas by 5-fold CV."""
    wide = shuffled_folds(_wide(spark, sf_dir).where("split = 'train'"))
    lm = L.enet_cv(wide, MODELS, "y_true", "fold")
    return spark.createDataFrame([(m, float(w)) for m, w in zip(MODELS, lm.coef)] +
                                 [("intercept", lm.intercept), ("alpha", lm.params["alpha"]), ("l1_ratio", lm.params["l1_ratio"])],
                                 "term string, value double")


@register("k13_out_of_fold")
def k13_out_of_fold(spark, sf_dir):
    """Out-of-fold ridge predictions - every training row predicted once, by the model without its fold."""
    wide = shuffled_folds(_wide(spark, sf_dir).where("split = 'train'"))
    oof = L.out_of_fold(wide, MODELS, "y_true", lambda st: L.solve_ridge(st, 1.0), "fold")
    return oof.select("sample_id", "fold", "oof")


@register("k12_k19_stacking_ensemble")
def k12_k19_stacking_ensemble(spark, sf_dir):
    """Ridge / elastic net / shallow trees with out-of-fold predictions, Nelder-Mead level-2
    weights, isotonic calibration; compared with each base model and the weighted average on validation.
    The fitted ensemble is saved and reloaded (S10) before it predicts the test split."""
    w0 = _wide(spark, sf_dir)
    wide = PR.cache_for_iterations(w0, w0.columns)
    comp, ens, _w = ST.train_ensemble(wide, MODELS)
    path = scratch_path(spark, "ensemble")
    ens.save(spark, path)
    back = ST.StackingEnsemble.load(spark, path)
    test = back.predict(wide.where("split = 'test'"))
    n_test = test.where(F.col("pred").isNotNull() & (F.col("pred") >= 0)).count()
    rows = comp.collect()
    out = spark.createDataFrame([(r["model"], r["val_smape"], r["improvement_over_average"]) for r in rows] +
                                [("test_rows_predicted", float(n_test), None)],
                                "model string, val_smape double, improvement_over_average double")
    wide.unpersist()
    return out


@register("k16_isotonic_calibration")
def k16_isotonic_calibration(spark, sf_dir):
    """Isotonic calibration of the weighted validation prediction (monotone, clipped at 0)."""
    v = _wide(spark, sf_dir).where("split = 'validation'")
    val = PR.cache_for_iterations(v, ["y_true", *MODELS])
    weighted = PR.weighted_expr(MODELS, PR.optimise_weights(val, MODELS, "y_true")).alias("weighted")
    model = fit_isotonic(val.select("y_true", weighted), "weighted", "y_true")
    val.unpersist()
    out = model.transform(v.select("sample_id", weighted), "weighted")
    return out.select("sample_id", "weighted", F.greatest("prediction", F.lit(0.0)).alias("calibrated"))


@register("k16_isotonic_discount_of_part", f"""
with m as (select l_partkey as x, sum(l_discount) as wy, count(*) as w from lineitem group by 1),
c as (select x, sum(wy) over (order by x) as cy, sum(w) over (order by x) as cw from m),
s as (select x, lag(cy, 1, 0) over (order by x) as py, lag(cw, 1, 0) over (order by x) as pw from c),
p as (select s.x as a, c.x as b, (c.cy - s.py) / (c.cw - s.pw) as mean from s join c on c.x >= s.x),
l as (select a, b, min(mean) over (partition by a order by b rows between current row and unbounded following) as low from p)
select b as l_partkey, {r6('max(low)')} as fitted from l group by b""")
def k16_isotonic_discount_of_part(spark, sf_dir):
    """K16 on all of ``lineitem``: the discount as a non-decreasing function of the part number."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_discount")
    model = fit_isotonic(rows, "l_partkey", "l_discount")
    return rounded(model.transform(rows.select("l_partkey").distinct(), "l_partkey", "fitted"))


@register("k20_feature_importance")
def k20_feature_importance(spark, sf_dir):
    """K20 + T01: feature importance (share of the gain) of a boosted model, top 20."""
    m, cols = _matrix(spark, sf_dir)
    model = B.train_variants(m, cols, variants=("lightgbm",))["lightgbm"]["model"]
    return B.feature_importance(model, spark).orderBy(F.col("importance").desc(), F.col("feature")).limit(20)


@register("k21_baseline_ridge")
def k21_baseline_ridge(spark, sf_dir):
    """Small baseline - ridge (alpha 1) on the numeric features in log space; SMAPE per split."""
    m, cols = _matrix(spark, sf_dir)
    lm = L.ridge_fit(m.where("split = 'train'"), cols, "label", 1.0)
    p = lm.transform(m)
    from ..operators.metrics import smape

    return rounded(smape(p.select("split", F.expm1("label").alias("y_true"), F.expm1("prediction").alias("pred")), by=["split"]))


@register("k15_weighted_average_predictions")
def k15_weighted_average_predictions(spark, sf_dir):
    """Optimised simple-average weights applied to every id (weights as a broadcast table)."""
    wide = _wide(spark, sf_dir)
    val = PR.cache_for_iterations(wide.where("split = 'validation'"), ["y_true", *MODELS])
    w = PR.optimise_weights(val, MODELS, "y_true")
    val.unpersist()
    return wide.select("sample_id", "split", PR.weighted_expr(MODELS, w).alias("pred"))


