"""W01-W09 against pandas; K10/K11/K13 against numpy closed forms; K14 weights; stacking smoke."""

import numpy as np
import pandas as pd

from pricelab.operators import windows as W
from pricelab.operators.predictions import optimise_weights, smape_of_weights
from pricelab.plans.models import linear as L


def _hist(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    stage = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b"], n))  # one stage holds most rows
    metric = np.where(rng.random(n) < 0.2, np.nan, rng.normal(10, 2, n))
    pdf = pd.DataFrame({"stage": stage, "event_id": np.arange(n), "ts": rng.permutation(n), "metric": metric})
    rows = [(r.stage, int(r.event_id), int(r.ts), None if np.isnan(r.metric) else float(r.metric)) for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "stage string, event_id long, ts long, metric double"), pdf


def test_running_scan_row_numbers_and_min(spark):
    df, pdf = _hist(spark)
    got = W.running_scan(df, ["ts", "event_id"], ["stage"], min_of="metric", partitions=7).toPandas()
    pdf = pdf.sort_values(["stage", "ts", "event_id"])
    pdf["rn"] = pdf.groupby("stage").cumcount() + 1
    pdf["run_min"] = pdf.groupby("stage")["metric"].cummin()
    m = got.merge(pdf, on="event_id")
    assert (m["_rn"] == m["rn"]).all()
    both = m.dropna(subset=["run_min"])
    assert np.allclose(both["_run_min"], both["run_min"])


def test_best_so_far_flags(spark):
    df, pdf = _hist(spark, 300, 3)
    got = W.best_so_far(df, order=("ts", "event_id")).toPandas().sort_values(["stage", "step"])
    for stage, g in got.groupby("stage"):
        best = np.inf
        for r in g.itertuples():
            new = r.metric is not None and not np.isnan(r.metric) and r.metric < best
            assert bool(r.is_new_best) == bool(new)
            if new:
                best = r.metric


def test_retention_keeps_newest_and_best(spark):
    rows = [("s", "quick", i, i, 10.0 - 0.1 * i if i != 2 else 0.5) for i in range(10)] + [("other", "quick", 100 + i, i, 1.0) for i in range(2)]
    df = spark.createDataFrame(rows, "stage string, checkpoint_type string, event_id long, ts long, metric double")
    keep = {r["event_id"]: r["keep"] for r in W.retention_plan(df).collect()}
    assert {k for k, v in keep.items() if v and k < 100} == {7, 8, 9, 2}
    assert keep[100] and keep[101]  # groups with <= 3 entries are untouched


def test_latest_and_best_step(spark):
    df, pdf = _hist(spark, 200, 5)
    latest = {r["stage"]: r["event_id"] for r in W.latest_entry(df).collect()}
    for s, g in pdf.groupby("stage"):
        assert latest[s] == g.sort_values(["ts", "event_id"]).iloc[-1]["event_id"]
    best = {r["stage"]: r["best_step"] for r in W.best_step(df).collect()}
    for s, g in pdf.dropna().groupby("stage"):
        assert best[s] == g.sort_values(["metric", "event_id"]).iloc[0]["event_id"]


def test_contiguous_folds_like_ntile(spark):
    df = spark.createDataFrame([(i,) for i in range(23)], "k long")
    got = sorted((r["k"], r["fold"]) for r in W.contiguous_folds(df, ["k"], 5).collect())
    sizes = np.bincount([f for _, f in got])
    assert list(sizes) == [5, 5, 5, 4, 4]
    assert [f for _, f in got] == sorted(f for _, f in got)


def _linear_data(spark, n=400, d=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(100, 10, size=(n, d))
    y = x @ np.array([0.5, -1.0, 2.0])[:d] + 3 + rng.normal(size=n)
    folds = rng.integers(0, 5, n)
    rows = [tuple(map(float, xi)) + (float(yi), int(f)) for xi, yi, f in zip(x, y, folds)]
    cols = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", y double, fold int")
    return df, x, y, folds, cols


def test_ridge_matches_closed_form(spark):
    df, x, y, _f, cols = _linear_data(spark)
    lm = L.ridge_fit(df, cols, "y", alpha=2.0)
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    w = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(lm.coef, w, rtol=1e-8) and np.isclose(lm.intercept, ym - xm @ w, rtol=1e-8)


def test_enet_kkt(spark):
    df, x, y, _f, cols = _linear_data(spark)
    lm = L.enet_cv(df, cols, "y", "fold", alphas=[0.5], l1_ratios=[0.5])
    n = len(y)
    r = y - x @ lm.coef - lm.intercept
    grad = -(x - x.mean(0)).T @ r / n + 0.5 * 0.5 * lm.coef  # l2 part
    for g, w in zip(grad, lm.coef):
        if w != 0:
            assert abs(g + 0.5 * 0.5 * np.sign(w)) < 1e-2
        else:
            assert abs(g) <= 0.5 * 0.5 + 1e-2


def test_out_of_fold_each_row_once(spark):
    df, x, y, folds, cols = _linear_data(spark)
    oof = L.out_of_fold(df, cols, "y", lambda st: L.solve_ridge(st, 1.0), "fold").toPandas()
    assert oof["oof"].notna().all() and len(oof) == len(y)
    k = 0
    m = folds != k
    xm, ym = x[m].mean(0), y[m].mean()
    w = np.linalg.solve((x[m] - xm).T @ (x[m] - xm) + np.eye(3), (x[m] - xm).T @ (y[m] - ym))
    pred = x[~m] @ w + ym - xm @ w
    got = oof[oof["fold"] == k]["oof"].to_numpy()
    assert np.allclose(np.sort(got), np.sort(pred), rtol=1e-8)


def test_weights_sum_to_one_and_not_worse(spark):
    rng = np.random.default_rng(2)
    t = rng.uniform(10, 1000, 300)
    rows = [(float(a), float(a * (1 + rng.normal(0, .1))), float(a * (1 + rng.normal(0, .3)))) for a in t]
    df = spark.createDataFrame(rows, "y double, m1 double, m2 double")
    w = optimise_weights(df, ["m1", "m2"], "y", max_iter=60)
    assert np.isclose(w.sum(), 1.0) and (w >= 0).all()
    s_opt, s_eq = smape_of_weights(df, ["m1", "m2"], "y", [w, np.array([0.5, 0.5])])
    assert s_opt <= s_eq + 1e-9


def test_smape_boost_first_round_is_newton_step(spark):
    """A one-leaf tree's value is the Newton step -sum(g) / sum(h)."""
    from pyspark.sql import functions as F

    from pricelab.plans.models.boost import smape_boost

    rng = np.random.default_rng(7)
    y = np.log1p(rng.uniform(10, 500, 200))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(size=200), y)], "x double, label double").withColumn("split", F.lit("train"))
    model = smape_boost(df, ["x"], growth="depth", rounds=1, rate=1.0, max_depth=0, alpha=0.0, lam=0.0, row_share=1.0, column_share=1.0)
    f0 = y.mean()
    p, t = max(np.expm1(f0), 1e-10), np.maximum(np.expm1(y), 1e-10)
    s = np.abs(t) + abs(p) + 1e-10
    g = (2 * np.sign(p - t) / s - 2 * np.abs(p - t) * np.sign(p) / s ** 2) * p
    h = np.clip(2 * p * p / s ** 2, 0.001, 10.0)
    pred = model.transform(df.limit(1)).collect()[0]["prediction"]
    assert np.isclose(pred, f0 - g.sum() / h.sum(), rtol=1e-9)


def test_isotonic_calibration_is_monotone(spark):
    from pyspark.ml.regression import IsotonicRegression
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    x = np.sort(rng.uniform(2, 12, 150))
    rows = [(float(a), float(a + rng.normal(0, 0.5))) for a in x]
    df = spark.createDataFrame(rows, "p double, y double")
    out = IsotonicRegression(featuresCol="p", labelCol="y").fit(df).transform(df)
    vals = [r["c"] for r in out.select(F.greatest("prediction", F.lit(0.0)).alias("c"), "p").orderBy("p").collect()]
    assert all(b >= a for a, b in zip(vals, vals[1:]))


def test_registered_model_jobs_have_the_whole_size(spark, monkeypatch):
    """The registered queries ask for all rounds, variants, trials and models (the fits themselves are cut short here)."""
    import dataclasses

    from pricelab.plans.models import boost as B
    from pricelab.queries import q_misc, q_models

    asked, fit = [], B.fit_fleet

    def short(matrix, columns, fleet, **kw):
        asked.append(fleet)
        assert "timeout_s" not in kw or kw["timeout_s"] is None
        return fit(matrix, columns, [dataclasses.replace(p, rounds=1) for p in fleet], **kw)

    monkeypatch.setattr(B, "fit_fleet", short)
    small = "/root/testdata/sf0.001"
    got = q_models.k08_prediction_table(spark, small).groupBy("model", "split").count().collect()
    assert sorted({(r.model, r.split) for r in got}) == [(m, s) for m in ("catboost", "lightgbm", "xgboost") for s in ("test", "train", "validation")]
    q_models.k20_feature_importance(spark, small)
    assert q_models.k09_random_search(spark, small).count() == 50
    assert [len(f) for f in asked] == [3, 1, 50]
    assert {(p.rounds, p.patience) for f in asked[:2] for p in f} == {(1000, 100)} and {(p.rounds, p.patience) for p in asked[2]} == {(1000, 50)}
    got = q_models.k16_isotonic_calibration(spark, small).orderBy("weighted").collect()
    assert got and all(a.calibrated <= b.calibrated for a, b in zip(got, got[1:]))
    assert [r.model for r in q_misc.a11_qq_fit_by_model(spark, small).orderBy("model").collect()] == ["catboost", "lightgbm", "neural_net", "xgboost"]


def test_incomplete_ids_are_an_error(spark, tmp_dir, monkeypatch):
    """Ids that lack a model's prediction are counted and raised, in the queries and in E2."""
    import pytest
    from pyspark.sql import functions as F

    from pricelab.plans.stages import ensemble_stage
    from pricelab.queries import q_models, q_predictions
    from pricelab.sources import store as ST

    rows = [(str(i), m, "test" if i < 10 else "train", 5.0 + i, 5.0) for i in range(40) for m in q_models.MODELS if (i, m) not in ((3, "lightgbm"), (7, "xgboost"), (20, "catboost"))]
    p = spark.createDataFrame(rows, "sample_id string, model string, split string, y_true double, pred double")
    monkeypatch.setattr(q_models, "predictions", lambda *a: p.drop("split"))
    monkeypatch.setattr(q_predictions, "predictions", lambda *a: p.drop("split"))
    for run in (q_models.k10_ridge_cv, q_models.k16_isotonic_calibration, q_predictions.k15_optimised_weights, q_predictions.k14_pattern_search_weights):
        with pytest.raises(ValueError, match="^3 ids"):
            run(spark, "")
    ST.save_predictions(p, tmp_dir + "/store")
    with pytest.raises(ValueError, match="^3 ids"):
        ensemble_stage(spark, tmp_dir + "/store", p.select("sample_id").distinct(), tmp_dir)
    assert [r.y_true for r in q_models.PR.require_complete(q_models.PR.stack_wide(p.where(F.col("sample_id") == "0"), q_models.MODELS, extra=("y_true",))).collect()] == [5.0]
