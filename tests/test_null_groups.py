"""Groups whose key is NULL, and NULL and NaN values, keep their rows."""

import math

import pytest

from pricelab.operators import metrics as M
from pricelab.operators.quantiles import exact_percentiles
from pricelab.operators.splits import stratified_split
from pricelab.operators.windows import best_so_far, decile_labels, early_stop, retention_plan


@pytest.fixture(scope="module")
def history(spark):
    rows = [(i, None if i % 4 == 0 else f"s{i % 2}", "full", 1000 + i, float(i % 7)) for i in range(40)]
    return spark.createDataFrame(rows, "event_id long, stage string, checkpoint_type string, ts long, metric double")


def test_null_group_keys_keep_their_rows(history):
    assert best_so_far(history).count() == 40
    assert retention_plan(history, 2).count() == 40
    assert {r.stage for r in early_stop(history, 3).collect()} == {None, "s0", "s1"}
    assert {r.stage for r in exact_percentiles(history, "metric", [0.25, 0.5], ["stage"]).collect()} == {None, "s0", "s1"}


def test_null_running_minimum_is_right(history):
    rows = sorted((r for r in best_so_far(history).collect() if r.stage is None), key=lambda r: r.ts)
    low = math.inf
    for r in rows:
        assert r.is_new_best == (r.metric < low)
        low = min(low, r.metric)
        assert r.best_so_far == low


def test_labels_of_null_and_nan(spark):
    rows = [(i, float(i), None if i % 3 == 0 else "g") for i in range(30)] + [(40, None, "g"), (41, float("nan"), "g"), (42, None, None)]
    frame = spark.createDataFrame(rows, "sample_id long, price double, g string")
    numbers = frame.where("price is not null and not isnan(price)")
    got = {r.sample_id: r.decile for r in decile_labels(numbers, "price", 5, ["g"]).collect()}
    assert len(got) == 30 and sorted(set(got.values())) == [0, 1, 2, 3, 4]
    assert {r.decile for r in decile_labels(frame, "price", 5).where("sample_id >= 40").collect()} == {None}
    split = stratified_split(frame.where("price is null or not isnan(price)"))
    assert split.count() == 32


def test_metrics_keep_null_groups(spark):
    rows = [(i, 10.0 + i, 11.0 + i, None if i % 4 == 0 else "m") for i in range(40)]
    frame = spark.createDataFrame(rows, "sample_id long, y_true double, pred double, model string")
    out = M.error_summary(frame, by=["model"])
    assert {r.model for r in out.collect()} == {None, "m"}
