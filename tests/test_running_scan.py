"""Ordered scans over fixed split points: NULLs, ties, repeats, hot groups, empty tables, odd column names."""

import math

import numpy as np
from pyspark.sql import functions as F

from pricelab.operators import metrics as M
from pricelab.operators import windows as W


def _rows(n=900, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        g = "hot" if rng.random() < 0.6 else [None, "", "b"][int(rng.integers(3))]
        ts = None if rng.random() < 0.1 else float(rng.choice([-2.5, 0.0, 1e-9, 3.25, 7.0, math.inf]))
        v = None if rng.random() < 0.2 else float(rng.integers(0, 50))
        out.append((g, ts, i, v))
    return out


def _plain(rows):
    """(row number, minimum up to, minimum before) per id by sorting and a loop."""
    key = lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or 0.0), r[2])
    seen, want = {}, {}
    for g, ts, i, v in sorted(rows, key=key):
        n, low = seen.get(g, (0, None))
        now = v if low is None else low if v is None else min(low, v)
        want[i] = (n + 1, now, low)
        seen[g] = (n + 1, now)
    return want


def test_scan_equals_a_loop_for_any_number_of_parts(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, ts double, id long, v double").repartition(5, "id")
    want = _plain(rows)
    for parts in (1, 3, 64, 2000):
        got = W.running_scan(df, ["ts", "id"], ["g"], min_of="v", partitions=parts).collect()
        assert {r["id"]: (r["_rn"], r["_run_min"], r["_min_before"]) for r in got} == want
        assert len(got) == len(rows)


def test_scan_keeps_columns_of_any_name_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, "b", 1)], "_pid long, `odd name` string, part long")
    got = W.running_scan(df, ["odd name", "_pid"])
    assert got.columns == ["_pid", "odd name", "part", "_rn"]
    assert [r["_rn"] for r in got.orderBy("_pid").collect()] == [1, 2]
    assert W.running_scan(df.where("part > 5"), ["_pid"], ["part"], min_of="_pid").collect() == []


def test_parts_never_fall_and_are_even_for_a_hot_group(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, "hot").otherwise("cold").alias("g"), F.col("id").alias("k"))
    x = W.with_part(df, ["g", "k"], 16)
    per = x.groupBy("part").agg(F.min(F.struct("g", "k")).alias("lo"), F.max(F.struct("g", "k")).alias("hi"), F.count(F.lit(1)).alias("n"))
    rows = per.orderBy("part").collect()
    assert len(rows) == 16 and max(r["n"] for r in rows) < 2 * 20000 / 16
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(rows, rows[1:]))


def test_scan_shuffles_rows_once_and_writes_none(spark):
    df = spark.range(1000).select("id", F.lit("wide").alias("text"))
    plan = W.running_scan(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "rangepartitioning" not in plan
    assert sum("text" in line for line in plan.splitlines() if "Exchange" in line) <= 1


def test_early_stop_equals_a_loop(spark):
    rng = np.random.default_rng(8)
    rows = [("ab"[int(rng.integers(2))], i, None if rng.random() < 0.1 else float(rng.random() + 1 / (1 + i))) for i in range(400)]
    df = spark.createDataFrame(rows, "stage string, ts long, metric double").withColumn("event_id", F.col("ts"))
    for patience in (1, 7, 500):
        want = {}
        for stage in "ab":
            best, last, stop, n = math.inf, 0, None, 0
            for _, _, m in [r for r in rows if r[0] == stage]:
                n += 1
                if m is not None and m < best:
                    best, last = m, n
                if last and n - last >= patience:
                    stop = n
                    break
            want[stage] = (stop or n, last, stop is not None)
        got = {r["stage"]: (r["stop_step"], r["best_step"], r["stopped_early"]) for r in W.early_stop(df, patience).collect()}
        assert got == want


def test_qq_fit_by_group_equals_one_fit_each(spark):
    rng = np.random.default_rng(2)
    rows = [(g, float(v)) for g in ("x", None, "y") for v in rng.normal(3, 2, 40)] + [("x", None), ("x", math.nan), ("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    fits = {r["g"]: r for r in M.qq_fit(df, "v", ["g"]).collect()}
    assert set(fits) == {"x", None, "y", "one"} and fits["one"]["slope"] is None
    for g in ("x", None, "y"):
        one = M.qq_fit(df.where(F.col("g").eqNullSafe(g)), "v").collect()[0]
        assert fits[g]["n"] == one["n"] == 40
        assert abs(fits[g]["slope"] - one["slope"]) < 1e-9 and abs(fits[g]["r"] - one["r"]) < 1e-9
    assert M.qq_fit(df.where("v > 1e9"), "v").collect() == []


def test_scan_after_joins_and_aggregates(spark):
    """The rows' part is computed on both sides of the join with the totals, over plans of their own."""
    ids = spark.range(300).selectExpr("cast(id % 100 as string) as k", "id").groupBy("k").agg(F.min("id").alias("v"))
    left = ids.join(spark.createDataFrame([("7",), ("8",)], "k string"), "k", "left_anti")
    got = W.batch_numbers(left, 10, ["k"])
    assert got.count() == 98
    rows = got.orderBy("row_idx").collect()
    assert [r["k"] for r in rows] == sorted(str(i) for i in range(100) if i not in (7, 8))
    assert [r["batch"] for r in rows] == [i // 10 for i in range(98)]
