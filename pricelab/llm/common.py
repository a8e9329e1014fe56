"""What several operators share: staged tables, exact ranks without a hot task, connected components."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: lineage ends there and
    a lost executor costs only its running tasks. The shuffle files behind it go once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def body(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def key_of(name: str) -> Column:
    """A string key that is never null and tells null from every value."""
    c = F.col(name).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c))


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores in front of those that ``df`` has as columns (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def bucket_of(buckets: int, *cols: str, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(buckets)).cast("int")


def ranked(df: DataFrame, key: str, salt: list[str], order: list[str], buckets: int, out: str = "rank") -> DataFrame:
    """Number the rows of each value of ``key`` (never null) from 0 without gaps.

    Rows of one key are spread over ``buckets`` by a hash of ``salt``, numbered inside their bucket, and
    shifted by the sizes of the buckets before: no task holds all rows of a frequent key."""
    spread = df.withColumn("__b", bucket_of(buckets, *salt))
    sizes = spread.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, "__b").orderBy(*order)
    numbered = spread.withColumn("__i", F.row_number().over(inside).cast("long") - 1)
    return numbered.join(starts, [key, "__b"]).withColumn(out, F.col("__start") + F.col("__i")).drop("__b", "__i", "__start")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: non-null longs) as (node, root), root the smallest node.

    Each round every node hooks to its smallest neighbour and the edges are contracted to those
    neighbours; the number of nodes with edges at least halves. Each round's parents are a written
    table, joined backwards at the end. Smallest neighbours are partial aggregates; the joins are on
    plain columns, so adaptive execution splits a node that holds many edges."""
    both = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = staged(both, f"{name}-edges")
    parents: list[DataFrame] = []
    while not live.isEmpty():
        ends = live.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        low = ends.select("e.*").groupBy("a").agg(F.min("b").alias("m"))
        parent = staged(low.select(F.col("a").alias("node"), F.least("a", "m").alias("up")), f"{name}-parents")
        parents.append(parent)
        pa = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        pb = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = live.join(pa, "a").join(pb, "b").where("ua <> ub")
        live = staged(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), f"{name}-edges")
    if not parents:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = parents[-1].select("node", F.col("up").alias("root"))
    for parent in reversed(parents[:-1]):
        over = root.select(F.col("node").alias("up"), "root")
        root = staged(parent.join(over, "up", "left").select("node", F.coalesce("root", "up").alias("root")), f"{name}-roots")
    return root


def worker_state(name: str, make):
    """An object that a Python worker keeps between its tasks (the library is pickled by value, so module
    globals do not outlive a task)."""
    kept = sys.modules.setdefault("_pricelab_worker_state", types.ModuleType("_pricelab_worker_state"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
