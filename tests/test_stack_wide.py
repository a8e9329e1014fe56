"""The wide table from one aggregate."""

from pricelab.operators.predictions import stack_wide


def test_one_shuffle_and_the_values_of_each_model(spark):
    rows = [("1", "a", 1.0), ("1", "b", 2.0), ("2", "b", 3.0), (None, "a", 4.0), ("3", "a", None), ("3", "b", 5.0), ("4", "c", 6.0), ("5", None, 7.0)]
    preds = spark.createDataFrame(rows, "sample_id string, model string, pred double").repartition(3)
    wide = stack_wide(preds, ["b", "a"])
    assert wide.columns == ["sample_id", "a", "b", "complete"]
    want = [(None, 4.0, None, False), ("1", 1.0, 2.0, True), ("2", None, 3.0, False), ("3", None, 5.0, False), ("4", None, None, False), ("5", None, None, False)]
    assert sorted(map(tuple, wide.collect()), key=lambda r: str(r[0])) == sorted(want, key=lambda r: str(r[0]))
    direct = stack_wide(spark.range(9).selectExpr("id % 3 as sample_id", "'a' as model", "id * 1.0D as pred"), ["a"])
    assert direct._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
