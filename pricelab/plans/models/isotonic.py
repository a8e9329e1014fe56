"""Isotonic regression whose blocks are pooled, merged, kept and applied as tables.

Rows of equal x become one weighted mean first (a partial aggregate, so a value that many rows share costs one row).
The means are cut into parts along x and every part is pooled by its own task: neighbours that fall are replaced by
their weighted mean until none falls. Pooling may be done in any order with the same result, so what is left are the
neighbours across the cuts: the blocks are numbered in order and pooled again in runs of ``BLOCKS_PER_TASK``, whose
ends lie in the middle of the runs of the round before, until two rounds in a row have pooled nothing. A task holds one part
or one run; no block reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.windows import running_scan, with_part
from ...session import cut_lineage

BLOCKS_PER_TASK = 1 << 16
BLOCK_SCHEMA = "lo double, hi double, wy double, w double"


def _pool(batches):
    """Pools the falling neighbours of each run ``g``; the rows come sorted by (g, lo)."""
    import pandas as pd

    def blocks(stack):
        return pd.DataFrame(stack, columns=["lo", "hi", "wy", "w"])

    run, stack = None, []
    for pdf in batches:
        for g, lo, hi, wy, w in zip(*(pdf[c].tolist() for c in ("g", "lo", "hi", "wy", "w"))):
            if g != run:
                if stack:
                    yield blocks(stack)
                run, stack = g, []
            while stack and stack[-1][2] * w >= wy * stack[-1][3]:
                before = stack.pop()
                lo, wy, w = before[0], before[2] + wy, before[3] + w
            stack.append((lo, hi, wy, w))
    if stack:
        yield blocks(stack)


def _pool_runs(blocks: DataFrame, run: Column) -> DataFrame:
    runs = blocks.select(run.alias("g"), "lo", "hi", "wy", "w").repartition("g").sortWithinPartitions("g", "lo")
    return cut_lineage(runs.mapInPandas(_pool, BLOCK_SCHEMA))


def _usable(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


@dataclass
class IsotonicModel:
    """Blocks (lo, hi, value, weight): ``value`` for x in [lo, hi]. Between two blocks the value is interpolated
    linearly, outside of all blocks it is the nearest block's."""

    blocks: DataFrame

    def save(self, path: str) -> None:
        self.blocks.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsotonicModel":
        return IsotonicModel(spark.read.parquet(path))

    def transform(self, df: DataFrame, x: str, out: str = "prediction") -> DataFrame:
        """``df`` with ``out``; NULL where x is NULL or NaN, and everywhere if the model has no block. The distinct
        values of x are placed among the blocks by two ordered scans and joined back."""
        at = F.col(f"`{x}`").cast("double")
        values = df.select(at.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).distinct()
        below, above = F.struct((-F.col("lo")).alias("n"), "hi", "value"), F.struct("lo", "value")
        marks = self.blocks.select(F.col("lo").alias("x"), F.lit(0).alias("kind"), below.alias("below"), above.alias("above"))
        rows = values.select("x", F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["below"].dataType).alias("below"),
                             F.lit(None).cast(marks.schema["above"].dataType).alias("above"))
        placed = cut_lineage(marks.union(rows)).withColumn("minus_x", -F.col("x"))
        up = running_scan(placed, ["x", "kind"], min_of="below").drop("below", "_rn").withColumnRenamed("_run_min", "b")
        both = running_scan(up.drop("_min_before"), ["minus_x", "kind"], min_of="above").where("kind = 1")
        b, a = F.col("b"), F.col("_run_min")
        share = (F.col("x") - b["hi"]) / (a["lo"] - b["hi"])
        value = (F.when(b.isNull(), a["value"]).when((F.col("x") <= b["hi"]) | a.isNull(), b["value"])
                 .otherwise(b["value"] + (a["value"] - b["value"]) * share))
        found = both.select(F.col("x").alias("__iso_x"), value.alias("__iso_value"))
        joined = df.join(found, at == F.col("__iso_x"), "left")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col("__iso_value").alias(out))


def fit_isotonic(df: DataFrame, x: str, y: str, weight: str | None = None, blocks_per_task: int = BLOCKS_PER_TASK) -> IsotonicModel:
    """The non-decreasing step function of x with the least weighted squared error to y. Rows whose
    x, y or weight is missing, NaN or infinite, or whose weight is not above 0, are left out; a table without usable
    rows gives no blocks."""
    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(f"`{x}`").cast("double").alias("x"), F.col(f"`{y}`").cast("double").alias("y"), w.alias("w")).where(
        _usable(F.col("x")) & _usable(F.col("y")) & _usable(F.col("w")) & (F.col("w") > 0))
    means = rows.groupBy("x").agg(F.sum(F.col("w") * F.col("y")).alias("wy"), F.sum("w").alias("w"))
    points = cut_lineage(means.select(F.col("x").alias("lo"), F.col("x").alias("hi"), "wy", "w"))
    blocks = _pool_runs(with_part(points, ["lo"]), F.col("part"))
    n, quiet, offset = blocks.count(), 0, 0
    while quiet < 2 and n > 1:
        single = n <= blocks_per_task  # one run holds all blocks: its pooling is final
        at = F.lit(0) if single else F.floor((F.col("_rn") - 1 + offset) / blocks_per_task)
        ranked = blocks if single else running_scan(blocks, ["lo"])
        blocks = _pool_runs(ranked, at)
        left = blocks.count()
        quiet = 2 if single else quiet + 1 if left == n else 0
        n, offset = left, blocks_per_task // 2 - offset
    return IsotonicModel(blocks.select("lo", "hi", (F.col("wy") / F.col("w")).alias("value"), F.col("w").alias("weight")))
