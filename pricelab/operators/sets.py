"""Key-set operations as semi/anti joins (shuffle on the key only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def id_overlap(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Ids in both (distinct)."""
    return a.select(key).intersect(b.select(key))


def id_diff(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Ids of ``a`` not in ``b`` (distinct)."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def missing_and_extra(expected: DataFrame, actual: DataFrame, key: str = "sample_id") -> DataFrame:
    """(issue, sample_id) for expected ids absent from ``actual`` and unexpected ids in it."""
    missing = id_diff(expected, actual, key).select(F.lit("missing").alias("issue"), key)
    extra = id_diff(actual, expected, key).select(F.lit("extra").alias("issue"), key)
    return missing.unionByName(extra)


def coverage(ids: DataFrame, found: DataFrame, key: str = "sample_id", by=()) -> DataFrame:
    """Share (percent) of ids that have a match in ``found``, per group."""
    by = list(by)
    hit = ids.join(found.select(key).distinct().withColumn("_f", F.lit(1)), key, "left")
    return hit.groupBy(*by).agg(F.count(F.lit(1)).alias("n_ids"), F.count("_f").alias("n_found"),
                                (F.avg(F.coalesce("_f", F.lit(0))) * 100.0).alias("coverage_pct"))


def merge_manifest(old: DataFrame, new: DataFrame, key: str = "sample_id", order: str = "attempt") -> DataFrame:
    """Union of progress records, latest status per id (top-1 per key: Spark plans it as
    a group limit before the shuffle)."""
    u = old.unionByName(new)
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def union_predictions(*dfs: DataFrame) -> DataFrame:
    """One long prediction table from per-model tables."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def join_keep_rows(raw: DataFrame, feats: DataFrame, key: str = "sample_id") -> DataFrame:
    """Raw x features on the key; the feature side must have unique keys, so the row count is kept.

    Uniqueness is checked first with one aggregate (cheaper than counting both sides)."""
    dup = feats.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if dup:
        raise ValueError(f"feature table has duplicate {key}: {dup[0][key]!r}")
    return raw.join(feats, key, "left")


def attach_targets(preds: DataFrame, ids: DataFrame, key: str = "sample_id") -> DataFrame:
    """Predictions with their ids/targets; any id present on one side only is an error."""
    bad = missing_and_extra(ids.select(key), preds.select(key), key).limit(1).collect()
    if bad:
        raise ValueError(f"prediction / id mismatch: {bad[0]['issue']} {bad[0][key]!r}")
    return preds.join(ids, key)


def pending_work(inputs: DataFrame, completed: DataFrame, existing: DataFrame | None = None,
                 key: str = "sample_id") -> DataFrame:
    """Ids still to process = input minus completed minus files already present."""
    todo = inputs.join(completed.select(key), key, "left_anti")
    if existing is not None:
        todo = todo.join(existing.select(key), key, "left_anti")
    return todo


def work_status(inputs: DataFrame, completed: DataFrame, failed: DataFrame, key: str = "sample_id") -> DataFrame:
    """Status per input id - 'skipped' (already completed), 'failed', 'pending'."""
    c = completed.select(key).distinct().withColumn("_c", F.lit(True))
    f = failed.select(key).distinct().withColumn("_f", F.lit(True))
    s = inputs.join(c, key, "left").join(f, key, "left")
    status = F.when(F.col("_c"), "skipped").when(F.col("_f"), "failed").otherwise("pending")
    return s.select(*inputs.columns, status.alias("status"))


def status_counts(status: DataFrame, statuses=("skipped", "failed", "pending")) -> DataFrame:
    """Counts per status in one row (pivot with an explicit value list: no extra job) + total."""
    p = status.groupBy().pivot("status", list(statuses)).agg(F.count(F.lit(1)))
    return p.select(*[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in statuses],
                    sum(F.coalesce(F.col(s), F.lit(0)) for s in statuses).cast("long").alias("total"))
