"""Candidates scored as data, two Nelder-Mead steps a job."""

import numpy as np
import pytest

from pricelab.operators import predictions as PR


def _wide(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.uniform(5, 100, n)
    preds = [y * (1 + rng.normal(b, s, n)) for b, s in ((0.1, 0.05), (-0.2, 0.1), (0.02, 0.3))]
    rows = [tuple(map(float, r)) for r in zip(y, *preds)]
    return rows, spark.createDataFrame(rows, "y double, `m a` double, b double, c double").repartition(5)


def _smape(rows, w):
    w = np.abs(w)
    w = w / w.sum() if w.sum() > 0 else np.full(len(w), 1 / len(w))
    x = np.array(rows)
    p = x[:, 1:] @ w
    return 100 * np.mean(np.abs(p - x[:, 0]) / ((np.abs(x[:, 0]) + np.abs(p)) / 2 + 1e-10))


def test_candidates_equal_numpy_and_null_rows_count_for_none(spark):
    rows, df = _wide(spark)
    more = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0), (5.0, None, 1.0, 1.0)], df.schema))
    cands = [np.array(c, dtype=float) for c in ([1, 0, 0], [1, 1, 1], [-2, 1, 0], [0, 0, 0])]
    got = PR.smape_of_weights(more, ["m a", "b", "c"], "y", cands)
    assert np.allclose(got, [_smape(rows, c) for c in cands], rtol=1e-12)
    with pytest.raises(ValueError, match="no row"):
        PR.smape_of_weights(df.where("y < 0"), ["m a", "b", "c"], "y", cands)


def test_search_takes_two_steps_a_job(spark, monkeypatch):
    rows, df = _wide(spark)
    jobs, steps = [], []
    monkeypatch.setattr(PR, "smape_of_weights", lambda w, m, t, c: jobs.append(len(c)) or [_smape(rows, x) for x in c])
    moves, ahead = PR._moves, PR._next_moves
    monkeypatch.setattr(PR, "_next_moves", lambda s: steps.append(1) or ahead(s))
    got = PR.optimise_weights(df, ["m a", "b", "c"], "y")
    assert len(jobs) <= len(steps) / 2 + 3 and moves is PR._moves
    monkeypatch.setattr(PR, "_next_moves", lambda s: [])  # one step a job finds the same
    assert np.array_equal(got, PR.optimise_weights(df, ["m a", "b", "c"], "y"))
    assert _smape(rows, got) < min(_smape(rows, e) for e in np.eye(3))
