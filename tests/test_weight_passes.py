"""Passes of the weight searches over packed rows."""

import numpy as np

from pricelab.operators import predictions as PR


def _wide(spark, n, parts):
    rng = np.random.default_rng(5)
    y = rng.uniform(5, 100, n)
    rows = [tuple(map(float, r)) for r in zip(y, *(y * (1 + rng.normal(b, 0.1, n)) for b in (0.1, -0.2)))]
    return rows, spark.createDataFrame(rows, "y double, a double, b double").repartition(parts)


def test_a_pass_is_one_job_of_few_tasks(spark, monkeypatch):
    rows, df = _wide(spark, 300, 40)
    sc = spark.sparkContext
    passes = []
    score = PR.smape_of_weights
    monkeypatch.setattr(PR, "smape_of_weights", lambda *a: passes.append(1) or score(*a))
    sc.setJobGroup("passes", "passes")
    PR.optimise_weights(df, ["a", "b"], "y")
    jobs = sc.statusTracker().getJobIdsForGroup("passes")
    tasks = [sc.statusTracker().getStageInfo(max(sc.statusTracker().getJobInfo(j).stageIds)).numTasks for j in jobs]
    sc.setJobGroup("rest", "rest")
    assert len(jobs) <= len(passes) + 3  # two or more a pass before
    assert sorted(tasks)[len(tasks) // 2] <= 2  # a task a partition before


def test_tasks_rise_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(PR, "PASS_ROWS", 50)
    rows, df = _wide(spark, 300, 40)
    packed = PR.PackedRows(df, ["a", "b"], "y")
    assert packed.rows.getNumPartitions() == 6
    cands = [np.array([1.0, 2.0]), np.array([0.0, 1.0])]
    x = np.array(rows)
    want = [100 * np.mean(np.abs(p - x[:, 0]) / ((x[:, 0] + np.abs(p)) / 2 + 1e-10)) for p in (x[:, 1:] @ (c / c.sum()) for c in cands)]
    assert np.allclose(PR.smape_of_weights(packed, ["a", "b"], "y", cands), want, rtol=1e-12)
    assert np.allclose(PR.smape_of_weights(df, ["a", "b"], "y", cands), want, rtol=1e-12)
    packed.close()
