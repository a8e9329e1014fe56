"""Exact percentiles: plans stay short over many passes, and rows stay where they are for a few groups."""

import pytest
from pyspark.sql import functions as F

from pricelab.operators import metrics as M
from pricelab.operators import quantiles as Q


def test_plans_do_not_grow_with_the_passes(spark, monkeypatch):
    lengths, beside = [], Q._beside_intervals

    def noted(rows, state, by):
        lengths.append(len(state._jdf.queryExecution().toString()))
        return beside(rows, state, by)

    monkeypatch.setattr(Q, "BUCKETS", 3)
    monkeypatch.setattr(Q, "_beside_intervals", noted)
    df = spark.range(400).select((F.col("id") % 2).alias("g"), (F.col("id") * 1.0).alias("v"))
    got = {r.g: r.value for r in Q.exact_percentiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {0: pytest.approx(199.0), 1: pytest.approx(200.0)}
    assert len(lengths) >= 5 and lengths[-1] <= 1.2 * lengths[1]


@pytest.mark.parametrize("measure", [M.smape_by_quantile, M.smape_by_qcut])
def test_few_groups_do_not_take_all_rows_to_few_tasks(spark, measure):
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("model"), (F.col("id") * 1.0).alias("y_true"), F.lit(7.0).alias("pred"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the size of the groups' table is not known
    try:
        out = measure(df, by=["model"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(((r["model"], r["count"]) for r in out.collect()), key=str) == sorted([(m, 20) for m in (None, "1", "2") for _ in range(5)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
