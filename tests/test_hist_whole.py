"""Models grown whole by one task each, against those grown level by level."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.plans.models import hist as H
from pricelab.plans.models import sums as S
from pricelab.plans.models import whole as W

COLUMNS = ["a", "b", "c", "d"]
FLEET = [
    H.TreeParams("leaf", rate=0.2, max_depth=-1, leaves=9, alpha=0.1, lam=0.1, min_rows=5, row_share=0.7, row_every=2, column_share=0.8, rounds=6, patience=None),
    H.TreeParams("leaf", rate=0.3, max_depth=3, leaves=40, lam=1e-8, min_rows=20, rounds=5, patience=None),
    H.TreeParams("depth", rate=0.3, max_depth=4, alpha=0.1, lam=0.1, min_weight=3.0, row_share=0.8, column_share=0.8, rounds=6, patience=None),
    H.TreeParams("depth", rate=0.1, max_depth=3, lam=0.1, objective="smape", rounds=5, patience=None),
    H.TreeParams("symmetric", rate=0.3, max_depth=4, lam=3.0, rounds=6, patience=None),
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    n = 900
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 40, n), rng.integers(0, 2, n), rng.normal(size=n)])
    y = 3 + np.sin(3 * x[:, 0]) + 0.02 * x[:, 1] * x[:, 2] + rng.normal(scale=0.05, size=n)
    data = [(*map(float, r), float(v), "validation" if i % 5 == 0 else "train") for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "a double, b double, c double, d double, label double, split string").coalesce(1).cache()


def by_level(monkeypatch, rows, fleet, columns=COLUMNS, **kw):
    with monkeypatch.context() as m:
        m.setattr(H, "fits_a_task", lambda *_: False)
        return H.fit_fleet(rows, columns, fleet, **kw)


def test_whole_models_equal_those_grown_level_by_level(rows, monkeypatch):
    monkeypatch.setattr(S, "FEW", 100)  # both ways of counting
    x = np.array([r[:4] for r in rows.collect()])
    for p, whole, level in zip(FLEET, H.fit_fleet(rows, COLUMNS, FLEET, max_bins=32), by_level(monkeypatch, rows, FLEET, max_bins=32)):
        assert np.allclose(whole.history, level.history, rtol=1e-9), p
        assert len(whole.trees) == len(level.trees) > 0 and np.allclose(whole.score(x), level.score(x), rtol=1e-9)
        assert np.allclose(whole.importance, level.importance)


@pytest.mark.parametrize("objective", ["squared", "smape"])
def test_rows_of_equal_bins_count_as_one_cell(rows, monkeypatch, objective):
    fleet = [dataclasses.replace(p, objective=objective, fold=k % 3) for k, p in enumerate(FLEET)]
    few = rows.select("b", "c", "label", F.lit("train").alias("split"), F.pmod(F.hash("a", "d"), F.lit(3)).alias("fold"))
    columns = ["b", "c"]
    monkeypatch.setattr(H, "PART_ROWS", 100)
    monkeypatch.setattr(H, "BLOCK_ROWS", 128)
    monkeypatch.setattr(H, "RESTAGE", 2)
    level = by_level(monkeypatch, few, fleet, columns, max_bins=16, fold="fold")
    monkeypatch.setattr(H, "MOST_CELLS", 0)
    plain = by_level(monkeypatch, few, fleet, columns, max_bins=16, fold="fold")
    x = np.array([[r.b, r.c] for r in few.collect()])
    for p, a, b in zip(fleet, level, plain):
        if p.row_share >= 1:  # blocks, and so the rows drawn, are others
            assert np.allclose(a.history, b.history, rtol=1e-9) and np.allclose(a.score(x), b.score(x), rtol=1e-9) and len(a.trees) == len(b.trees)
        assert np.isclose(a.history[0][1], b.history[0][1]) and min(h[1] for h in a.history) < a.history[0][1]


def test_a_block_of_cells_has_its_bins_once_a_cell(rows):
    few = rows.select("b", "c", "label", "split")
    edges = H.bin_edges(few, ["b", "c"], 16)
    table = H.block_table(few, ["b", "c"], edges, "label", "split", cells=2)
    chunk = H.joined([tuple(r) for r in table.collect()])
    assert sum(chunk.runs) == len(chunk.label) == 900 and chunk.bins.shape[1] == len(chunk.runs) < 120
    want = sorted(zip(*(np.searchsorted(e, [r[c] for r in few.collect()]).tolist() for c, e in zip("bc", edges)), [r.label for r in few.collect()]))
    assert sorted(zip(*np.repeat(chunk.bins, chunk.runs, axis=1).tolist(), chunk.label.tolist())) == want


def test_a_model_takes_no_job_a_level(spark, rows, monkeypatch):
    monkeypatch.setattr(H, "PART_ROWS", 100)  # not few rows, but a model for every core
    cores = spark.sparkContext.defaultParallelism
    fleet = [dataclasses.replace(FLEET[i % 2], seed=i, rounds=20) for i in range(cores + 1)]
    sc = spark.sparkContext
    sc.setJobGroup("whole", "whole")
    models = H.fit_fleet(rows, COLUMNS, fleet)
    jobs = len(sc.statusTracker().getJobIdsForGroup("whole"))
    sc.setJobGroup("rest", "rest")
    assert jobs < 20 and all(len(m.history) == 21 for m in models)  # a job a level before: over 80


def test_only_bounded_rows_go_to_one_task():
    assert H.fits_a_task(20_000, 16, 1, 12) and H.fits_a_task(1_200_000, 16, 50, 12) and H.fits_a_task(7_200_000, 16, 3, 12)
    assert not H.fits_a_task(7_200_000, 16, 50, 12) and not H.fits_a_task(9_000_000, 16, 3, 12) and not H.fits_a_task(1_200_000, 16, 1, 12) and not H.fits_a_task(43_000_000, 4, 6, 12)


def test_a_time_limit_is_shared(rows):
    models = H.fit_fleet(rows, COLUMNS, [dataclasses.replace(p, rounds=10**6) for p in FLEET[:3]], timeout_s=5.0)
    assert all(1 < len(m.history) < 10**6 and len(m.trees) < len(m.history) for m in models)


def test_columns_are_counted_together_up_to_a_number_of_cells():
    groups = S.together([64, 2, 64, 64, 2, 30, 300], 4096)
    assert sorted(c for g in groups for c in g) == list(range(7)) and groups[0][0] == 6 and len(groups) == 3
    rng = np.random.default_rng(1)
    sizes = [5, 64, 2, 40]
    bins = np.stack([rng.integers(0, s, 5000) for s in sizes]).astype(np.uint8)
    g, unit = W.rounded(rng.normal(size=5000))
    for some in (slice(None), slice(5, 4000), np.arange(0, 5000, 2), np.arange(7)):
        sums = S.Binned(bins, sizes, 64).sums(some, [g, None])
        at = np.arange(5000)[some]
        assert all(np.array_equal(sums[0, c], np.bincount(b[at], g[at], 64)) and np.array_equal(sums[1, c], np.bincount(b[at], minlength=64)) for c, b in enumerate(bins))
    assert (g * unit).sum() * 2 == (np.sort(g) * unit * 2).sum()  # in any order
