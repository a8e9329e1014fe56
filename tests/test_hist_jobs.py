"""Jobs and tasks of the boosted trees."""

import numpy as np
import pytest

from pricelab.plans.models import hist as H

COLUMNS = ["a", "b"]


def test_a_step_is_one_job_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(H, "PART_ROWS", 100)
    monkeypatch.setattr(H, "RESTAGE", 4)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2)).round(2)
    y = 3 + x[:, 0] * x[:, 1] + rng.normal(scale=0.05, size=600)
    rows = [(float(a), float(b), float(v), "validation" if i % 5 == 0 else "train") for i, ((a, b), v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, label double, split string").repartition(3).cache()
    steps = []
    run_steps = H.run_steps
    monkeypatch.setattr(H, "run_steps", lambda data, parts, *rest: steps.append(parts) or run_steps(data, parts, *rest))
    p = H.TreeParams("depth", rate=0.3, max_depth=4, lam=1.0, row_share=0.8, rounds=12, patience=None)
    sc = spark.sparkContext
    sc.setJobGroup("hist-jobs", "hist-jobs")
    model = H.fit_fleet(df, COLUMNS, [p])[0]
    jobs = len(sc.statusTracker().getJobIdsForGroup("hist-jobs"))
    sc.setJobGroup("rest", "rest")
    assert len(model.history) == 13 and len(steps) > 40 and set(steps) == {3}
    assert jobs < len(steps) + 35  # two jobs a step before
    assert model.at_best()[1] < 0.6 * model.history[0][1]


@pytest.mark.parametrize("rows, blocks, cores, tasks", [(0, 0, 12, 1), (20_000, 3, 12, 1), (1_200_000, 150, 12, 12), (7_200_000, 900, 12, 12), (7_300_000, 900, 12, 24), (1_200_000, 5, 12, 5)])
def test_rows_are_dealt_evenly_over_the_cores(rows, blocks, cores, tasks):
    assert H.parts_of(rows, blocks, cores) == tasks


def test_leaves_are_those_of_a_plain_walk():
    tree = H.Tree(*(np.array(v, np.int32) for v in ([1, -1, 0, -1, -1], [3, 0, 5, 0, 0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1])), np.zeros(5))
    bins = np.random.default_rng(0).integers(0, 9, (2, 500)).astype(np.uint8)
    want = [1 if b <= 3 else 3 if a <= 5 else 4 for a, b in bins.T.tolist()]
    assert tree.apply(bins).tolist() == want and tree.apply(bins[:, :0]).tolist() == []
    some = np.arange(0, 500, 7)
    assert {int(r): leaf for leaf, rows in tree.leaves(bins, some) for r in rows} == {int(r): want[r] for r in some}
