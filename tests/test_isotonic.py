"""Isotonic blocks pooled in parts against a plain pool-adjacent-violators loop and Spark's own model."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.plans.models import isotonic as I


def _plain(rows):
    """x -> fitted value: max over starts of min over ends of the weighted mean."""
    xs = sorted({r[0] for r in rows})
    wy = np.array([sum(r[1] * r[2] for r in rows if r[0] == x) for x in xs])
    w = np.array([sum(r[2] for r in rows if r[0] == x) for x in xs])
    cy, cw = np.concatenate([[0], np.cumsum(wy)]), np.concatenate([[0], np.cumsum(w)])
    n = len(xs)
    return {xs[i]: max(min((cy[b + 1] - cy[a]) / (cw[b + 1] - cw[a]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)}


def _cases():
    rng = np.random.default_rng(6)
    noisy = [(float(x), float(x + rng.normal(0, 20)), float(rng.integers(1, 4))) for x in rng.integers(0, 60, 250)]
    falling = [(float(i), float(-i), 1.0) for i in range(70)]
    rising = [(float(i), float(i), 1.0) for i in range(70)]
    hot = [(5.0, float(i % 7), 1.0) for i in range(100)] + [(float(i), float(i), 1.0) for i in range(10)]
    return {"noisy": noisy, "falling": falling, "rising": rising, "hot": hot, "one": [(1.0, 2.0, 1.0)]}


@pytest.mark.parametrize("name", list(_cases()))
def test_blocks_equal_the_definition(spark, name):
    rows = _cases()[name]
    df = spark.createDataFrame(rows, "x double, y double, w double").repartition(4)
    want = _plain(rows)
    for per_task in (4, 1 << 16):
        model = I.fit_isotonic(df, "x", "y", "w", blocks_per_task=per_task)
        got = {r["x"]: r["prediction"] for r in model.transform(df, "x").collect()}
        assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_equals_sparks_model_between_and_outside_of_blocks(spark, tmp_dir):
    from pyspark.ml.regression import IsotonicRegression

    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(float(x), float(x ** 2 + rng.normal(0, 8))) for x in rng.uniform(0, 10, 300)], "x double, y double")
    grid = spark.createDataFrame([(i, float(v)) for i, v in enumerate(np.linspace(-3, 13, 200))], "prediction long, x double")
    model = I.fit_isotonic(df, "x", "y")
    model.save(tmp_dir + "/iso")
    ours = I.IsotonicModel.load(spark, tmp_dir + "/iso").transform(grid, "x", "p").orderBy("prediction").collect()
    theirs = IsotonicRegression(featuresCol="x", labelCol="y").fit(df).transform(grid.withColumnRenamed("prediction", "i")).orderBy("i").collect()
    assert len(ours) == 200 and all(abs(a["p"] - b["prediction"]) < 1e-9 for a, b in zip(ours, theirs))


def test_missing_and_odd_values(spark):
    inf, nan = math.inf, math.nan
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (None, 9.0), (nan, 9.0), (2.0, None), (1.5, nan), (inf, 2.0), (-inf, 8.0)], "`a b` double, y double")
    model = I.fit_isotonic(df, "a b", "y")
    got = model.transform(df.select("a b"), "a b").collect()
    assert len(got) == 8
    value = {r["a b"]: r["prediction"] for r in got if r["a b"] is not None and not math.isnan(r["a b"])}
    assert value == {1.0: 1.0, 2.0: 3.0, 1.5: 2.0, inf: 3.0, -inf: 1.0}
    assert [r["prediction"] for r in got if r["a b"] is None or math.isnan(r["a b"])] == [None, None]
    empty = I.fit_isotonic(df.where("y = -77"), "a b", "y")
    assert empty.blocks.count() == 0
    assert [r["prediction"] for r in empty.transform(df.where("y = 3.0"), "a b").collect()] == [None]
    assert model.transform(df.where("y = -77"), "a b").count() == 0
