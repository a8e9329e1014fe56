"""Scoring rows by the leaf masks of trees, and all models in one pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.plans.models import boost as B
from pricelab.plans.models import hist as H


def grown(rng, leaves, sizes, growth="leaf"):
    g = H.Growth(H.TreeParams(growth, max_depth=-1, leaves=leaves))
    while (np.array(g.feature) < 0).sum() < leaves:
        node = int(rng.choice([i for i, f in enumerate(g.feature) if f < 0]))
        f = int(rng.integers(len(sizes)))
        g.split(node, f, int(rng.integers(sizes[f])), rng.normal(size=3), rng.normal(size=3) ** 2 + 3)
    return g.tree(looked_ahead=False)


@pytest.mark.parametrize("leaves", [1, 2, 31, 64, 65])
def test_masks_find_the_leaf_of_the_walk(leaves):
    rng = np.random.default_rng(leaves)
    sizes = [64, 2, 17, 1]
    bins = np.stack([rng.integers(0, s, 3000) for s in sizes]).astype(np.uint8)
    for _ in range(5):
        t = grown(rng, leaves, sizes)
        masks = H.LeafMasks.of(t, sizes)
        assert (masks is None) == (leaves > 64)
        if masks:
            assert np.array_equal(masks.values(bins), t.value[t.apply(bins)])


def test_predictions_of_all_models_come_from_one_read(spark):
    rng = np.random.default_rng(2)
    rows = [(str(i), float(a), float(b), float(a * b), ("train", "validation", "test")[i % 3]) for i, (a, b) in enumerate(rng.uniform(1, 2, (300, 2)))]
    df = spark.createDataFrame(rows, "sample_id string, a double, b double, label double, split string")
    fleet = [H.TreeParams(g, rate=0.3, max_depth=3, leaves=6, rounds=5, patience=None) for g in ("leaf", "depth", "symmetric")]
    models = dict(zip("xyz", H.fit_fleet(df, ["a", "b"], fleet)))
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        read.add(1)
        return v

    long = B.predictions_long({**models, "w": None}, df.withColumn("a", counted.asNondeterministic()("a")))
    got = {(r.model, r.sample_id): r for r in long.collect()}
    assert read.value == 300 and len(got) == 900 and long.columns == ["model", "split", "sample_id", "pred", "y_true"]  # a read a model before
    x = np.array([r[1:3] for r in rows])
    for name, m in models.items():
        assert np.allclose([got[name, r[0]].pred for r in rows], np.expm1(m.score(x)))
        sym = df.select("sample_id", models["z"].expression(F.array("a", "b")).alias("p")).collect()
    assert np.allclose([r.p for r in sym], models["z"].score(x)) and got["x", "4"].split == "validation"
