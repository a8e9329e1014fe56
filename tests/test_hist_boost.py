"""Boosted trees on histograms against a plain numpy version and their stated properties."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.plans.models import hist as H

COLUMNS = ["a", "b", "c"]


def data(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 30, n), rng.normal(size=n).round(2), rng.integers(0, 2, n)]).astype(float)
    y = 3 + 0.05 * x[:, 0] + np.where(x[:, 1] > 0, 0.5, 0) * x[:, 2] + rng.normal(scale=0.05, size=n)
    return x, y, np.where(np.arange(n) % 5 == 0, "validation", "train")


def frame(spark, x, y, split):
    rows = [(*map(float, r), float(v), s) for r, v, s in zip(x, y, split)]
    return spark.createDataFrame(rows, "a double, b double, c double, label double, split string").repartition(3)


def shrunk(g, alpha):
    return 0.0 if abs(g) <= alpha else g - alpha if g > 0 else g + alpha


def plain_boost(bins, y, p, init, rounds):
    """Depth-wise second-order trees by exhaustive search over rows; the margins after ``rounds``."""
    margin = np.full(len(y), init)

    def loss(idx):
        return shrunk((margin[idx] - y[idx]).sum(), p.alpha) ** 2 / (len(idx) + p.lam)

    for _ in range(rounds):
        step = np.zeros(len(y))
        leaves = [(np.arange(len(y)), 0)]
        while leaves:
            idx, depth = leaves.pop()
            best = (1e-12, None)
            if depth < p.max_depth:
                for f in range(len(bins)):
                    for b in range(bins[f].max() + 1):
                        left = bins[f, idx] <= b
                        if min(left.sum(), (~left).sum()) < max(p.min_rows, p.min_weight):
                            continue
                        gain = 0.5 * (loss(idx[left]) + loss(idx[~left]) - loss(idx))
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            if best[1] is None:
                step[idx] = -p.rate * shrunk((margin[idx] - y[idx]).sum(), p.alpha) / (len(idx) + p.lam)
            else:
                leaves += [(idx[best[1]], depth + 1), (idx[~best[1]], depth + 1)]
        margin = margin + step
    return margin


@pytest.mark.parametrize("split_blocks", [False, True])
def test_depth_wise_trees_equal_a_plain_version(spark, monkeypatch, split_blocks):
    if split_blocks:  # many blocks in several partitions, margins written every second round
        monkeypatch.setattr(H, "PART_ROWS", 200)
        monkeypatch.setattr(H, "RESTAGE", 2)
    x, y, split = data()
    p = H.TreeParams("depth", rate=0.3, max_depth=3, alpha=0.7, lam=2.0, min_weight=3.0, min_rows=5, rounds=5, patience=None)
    model = H.fit_fleet(frame(spark, x, y, split), COLUMNS, [p], max_bins=16)[0]
    train = split == "train"
    bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(model.edges)])
    want = plain_boost(bins[:, train], y[train], p, y[train].mean(), len(model.trees))
    assert len(model.history) == 6 and len(model.trees) == min(range(6), key=lambda i: model.history[i][1]) > 0
    assert np.allclose(model.score(x[train]), want, atol=1e-9)


def test_early_stopping_cuts_to_the_best_round(spark):
    x, _, split = data(400, 1)
    y = np.random.default_rng(2).normal(3, 0.3, 400)  # nothing to learn
    p = H.TreeParams("depth", rate=0.5, max_depth=4, lam=0.0, patience=7)
    model = H.fit_fleet(frame(spark, x, y, split), COLUMNS, [p])[0]
    best = min(range(len(model.history)), key=lambda i: model.history[i][1])
    assert model.best_iteration == best == len(model.trees) and len(model.history) - 1 - best == 7
    got = model.transform(frame(spark, x, y, split).where("split = 'validation'")).agg(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]
    assert np.isclose(got, model.at_best()[1])


def test_leaf_wise_growth(spark):
    x, y, split = data()
    df = frame(spark, x, y, split)
    leaf = [H.TreeParams("leaf", rate=1.0, max_depth=-1, leaves=n, lam=0.1, min_rows=5, rounds=1, patience=None) for n in (8, 31)]
    depth = H.TreeParams("depth", rate=1.0, max_depth=3, lam=0.1, min_rows=5, rounds=1, patience=None)
    eight, many, level = H.fit_fleet(df, COLUMNS, [*leaf, depth])
    assert (eight.trees[0].feature < 0).sum() == 8 == (level.trees[0].feature < 0).sum() and (many.trees[0].feature < 0).sum() <= 31

    def left_over(m):
        t = split == "train"
        return ((m.score(x[t]) - y[t]) ** 2).sum()

    assert left_over(eight) <= left_over(level) and left_over(many) <= left_over(eight)


def test_symmetric_trees_score_as_they_are_walked(spark, tmp_path):
    x, y, split = data()
    x[3, 1], x[4, 0] = 1e9, -1e9
    df = frame(spark, x, y, split)
    model = H.fit_fleet(df, COLUMNS, [H.TreeParams("symmetric", rate=0.3, max_depth=4, lam=3.0, rounds=6, patience=None)])[0]
    for t in model.trees:  # one condition a level
        level = [0]
        while t.feature[level[0]] >= 0:
            assert len({(t.feature[i], t.threshold[i]) for i in level}) == 1
            level = [int(c) for i in level for c in (t.left[i], t.right[i])]
    rows = model.transform(df).collect()
    assert model.trees and np.allclose([r.prediction for r in rows], model.score(np.array([[r.a, r.b, r.c] for r in rows])))
    model.save(spark, str(tmp_path / "m"))  # S11
    back = H.HistModel.load(spark, str(tmp_path / "m"))
    assert np.array_equal(back.score(x), model.score(x)) and back.params == model.params and back.history == model.history


def test_a_fleet_gives_what_its_models_give_alone(spark):
    x, y, split = data(300)
    df = frame(spark, x, y, split).coalesce(1)
    fleet = [H.TreeParams("leaf", max_depth=-1, leaves=6, rate=0.2, row_share=0.7, row_every=2, column_share=0.7, rounds=4, patience=None),
             H.TreeParams("depth", max_depth=2, rate=0.1, rounds=3, patience=None, objective="smape", lam=0.1), H.TreeParams("symmetric", max_depth=3, rounds=6, patience=2)]
    together = H.fit_fleet(df, COLUMNS, fleet)
    for p, m in zip(fleet, together):
        alone = H.fit_fleet(df, COLUMNS, [p])[0]
        assert np.allclose(alone.score(x), m.score(x)) and np.allclose(alone.history, m.history)


def test_smape_objective_beats_the_constant(spark):
    x, y, split = data(500, 5)
    model = H.fit_fleet(frame(spark, x, y, split), COLUMNS, [H.TreeParams("depth", objective="smape", max_depth=4, rate=0.3, lam=0.1, rounds=60, patience=20)])[0]
    assert model.at_best()[2] < 0.75 * model.history[0][2]


def test_edges_of_the_input(spark):
    x, y, split = data(60)
    df = frame(spark, x, y, split)
    p = H.TreeParams("leaf", rounds=3)
    assert H.fit_fleet(df, [], [p])[0].score(np.zeros((2, 0))).tolist() == [pytest.approx(y[split == "train"].mean())] * 2
    with pytest.raises(ValueError, match="no training rows"):
        H.fit_fleet(df.where("1 = 0"), COLUMNS, [p])
    odd = df.withColumn("b", F.when(F.col("a") > 10, F.lit(float("nan"))).when(F.col("a") > 5, F.lit(None)).otherwise(F.col("b")))
    model = H.fit_fleet(odd.where("split = 'train'"), COLUMNS, [dataclasses.replace(p, patience=2)])[0]  # no validation rows: all rounds
    assert len(model.trees) == 3 and model.transform(odd).where("prediction is null or isnan(prediction)").count() == 0


def test_models_of_folds_learn_from_the_other_folds(spark):
    x, y, split = data(300)
    df = frame(spark, x, y, split).where("split = 'train'").withColumn("fold", F.pmod(F.hash("a", "b", "c"), F.lit(3))).coalesce(1).cache()
    p = H.TreeParams("depth", max_depth=2, rate=0.3, rounds=6, patience=None)
    together = H.fit_fleet(df, COLUMNS, [*(dataclasses.replace(p, fold=k) for k in range(3)), p], fold="fold")
    for k, m in enumerate(together):
        rest = df.withColumn("split", F.when(F.col("fold") == k, "validation").otherwise("train"))
        assert np.isclose(m.init, rest.where("split = 'train'").agg(F.avg("label")).first()[0])
        if k < 3:  # measured on its fold
            got = m.transform(rest.where("split = 'validation'")).agg(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]
            assert np.isclose(got, m.at_best()[1])
    assert len(together[3].trees) == 6 and together[3].history[0][1] == 0  # all rows, all rounds
    no_fold = df.withColumn("label", F.when(F.col("fold") == 1, F.col("label") + 100).otherwise(F.col("label")))
    again = H.fit_fleet(no_fold, COLUMNS, [dataclasses.replace(p, fold=1, patience=None, rounds=1)], fold="fold")[0]
    assert np.isclose(again.init, together[1].init)  # its own labels do not reach it


def test_stacking_learner_takes_a_job_a_level(spark, tmp_path):
    from pricelab.plans.models import stack as ST

    n = 1500
    rng = np.random.default_rng(3)
    y = rng.uniform(1000, 5000, n)
    rows = [(str(i), "validation" if i % 10 == 0 else "train" if i % 10 < 8 else "test", float(v), *(float(v * (1 + e)) for e in rng.normal(0, 0.1, 2))) for i, v in enumerate(y)]
    wide = spark.createDataFrame(rows, "sample_id string, split string, y_true double, a double, b double").coalesce(2).cache()
    sc = spark.sparkContext
    sc.setJobGroup("stack", "stack")
    comp, ens, _ = ST.train_ensemble(wide, ["a", "b"])
    jobs = len(sc.statusTracker().getJobIdsForGroup("stack"))
    sc.setJobGroup("rest", "rest")
    assert jobs < 900  # one learner after the other took thousands
    scores = {r.model: r.val_smape for r in comp.collect()}
    assert scores["stacking"] < min(scores["a"], scores["b"])
    ens.save(spark, str(tmp_path / "e"))
    test = wide.where("split = 'test'")
    key = lambda e: sorted((r.sample_id, r.pred) for r in e.predict(test).collect())
    assert key(ST.StackingEnsemble.load(spark, str(tmp_path / "e"))) == key(ens)
