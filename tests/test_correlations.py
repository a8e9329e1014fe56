"""A15 against pandas: gappy, constant, large-valued and infinite columns."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricelab.operators import profile as P


def _table(n=500, d=40, gappy=5, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 4))
    x = base[:, rng.integers(0, 4, d)] * rng.choice([-2.0, 0.5, 30.0], d) + rng.normal(size=(n, d)) * rng.choice([0.05, 2.0], d)
    x[:, 1] += 1e6  # far from zero
    x[:, 2] = 7.25  # constant
    for j in range(3, 3 + gappy):
        x[rng.random(n) < 0.4, j] = np.nan
    x[:, 9] = np.where(rng.random(n) < 0.5, np.nan, 3.0)  # constant where present
    x[:, 10] = np.nan
    return pd.DataFrame(x, columns=[f"c {j}" for j in range(d)])


def _frame(spark, pdf):
    rows = [tuple(None if math.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)) for i, r in enumerate(pdf.to_numpy())]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(6)


def test_pairs_equal_pandas(spark):
    pdf = _table()
    corr = pdf.corr()
    cols = list(pdf.columns)
    for threshold in (0.95, 0.3):
        want = {(a, b): corr.loc[a, b] for i, a in enumerate(cols) for b in cols[i + 1:] if abs(corr.loc[a, b]) > threshold}
        want = {p: r for p, r in want.items() if not set(p) & {"c 2", "c 9", "c 10"}}
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.high_correlations(_frame(spark, pdf), threshold=threshold).collect()}
        assert set(got) == set(want) and len(want) > 5
        assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_infinite_values_touch_their_own_pairs_only(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.5], "b": [2.0, 4.0, 6.0, 9.0], "c": [1.0, math.inf, 3.0, 4.0]})
    got = P.high_correlations(spark.createDataFrame(pdf)).collect()
    assert [(r["col_a"], r["col_b"]) for r in got] == [("a", "b")] and abs(got[0]["corr"] - 1) < 1e-12


def test_empty_and_single_column(spark):
    df = spark.createDataFrame([], "a double, b long, t string")
    assert P.high_correlations(df).collect() == []
    assert P.high_correlations(df.select("a", "t")).collect() == []
    one = spark.createDataFrame([(1.0, 2)], "a double, b long")
    assert P.high_correlations(one).collect() == []


def test_a_task_sends_one_row_a_pair(spark):
    df = spark.range(10000, numPartitions=3).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).cast("int").alias("c"))
    got = {(r["i"], r["j"]): r for r in P.masked_gram_sums(df, ["a", "b", "c"]).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 2)}
    assert got[(0, 1)]["n"] == 10000 and got[(0, 2)]["n"] == got[(1, 2)]["n"] == 0


def test_rows_are_made_once(spark):
    """The passes for the means and for the products read the same cached columns."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def dear(v):
        made.add(1)
        return v * 2.0

    df = spark.range(50).select(F.col("id").cast("double").alias("a")).select("a", dear("a").alias("b"))
    assert [(r.col_a, r.col_b) for r in P.high_correlations(df, ["a", "b"]).collect()] == [("a", "b")]
    assert made.value == 50
