"""Q01-Q03: build and validate the submission table (E2's last step)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.errors import clip
from ..operators.sets import missing_and_extra


def build_submission(preds: DataFrame, key: str = "sample_id", pred: str = "pred", from_log_space: bool = False,
                     clip_min: float | None = 0.0, clip_max: float | None = None, price_col: str = "price") -> DataFrame:
    """Q02: optional expm1 (M02), clip (P09), types (P02): ``(sample_id STRING, price DOUBLE)``."""
    p = F.col(pred).cast("double")
    if from_log_space:
        p = F.expm1(p)
    return preds.select(F.col(key).cast("string").alias(key), clip(p, clip_min, clip_max).alias(price_col))


SIZE_LIMIT_BYTES = 5 * 1024 * 1024  # FIXED VALUE: submission file size limit


def validation_report(sub: DataFrame, expected: DataFrame, key: str = "sample_id", price_col: str = "price",
                      expected_rows: int | None = None, size_limit: int | None = None) -> DataFrame:
    """Q01 + Q03: one row per check ``(check, severity, n, ok)``.

    Errors: missing columns, missing ids, NaN / negative / infinite prices, row count, duplicate ids,
    non-positive prices. Warnings: extra ids. Value checks share one aggregate; id checks are anti joins."""
    spark = sub.sparkSession
    rows = []
    for c in (key, price_col):
        rows.append((f"column_{c}", "error", 0 if c in sub.columns else 1))
    if key not in sub.columns or price_col not in sub.columns:
        return spark.createDataFrame(rows, "check string, severity string, n long").withColumn("ok", F.col("n") == 0)
    p = F.col(price_col)
    agg = sub.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.isnan(p).cast("long")).alias("nan"),
        F.sum((p < 0).cast("long")).alias("negative"),
        F.sum((F.abs(p) == F.lit(float("inf"))).cast("long")).alias("infinite"),
        F.sum((~(p > 0) | F.isnan(p) | p.isNull()).cast("long")).alias("non_positive"),
        F.count(F.lit(1)).alias("_n"), F.countDistinct(key).alias("_d"),
        # bytes of the CSV the table becomes: id, comma, price text, newline per row (UTF-8)
        F.sum(F.octet_length(F.col(key).cast("string")) + F.octet_length(p.cast("string")) + 2).alias("_bytes"),
    ).collect()[0]
    ids = missing_and_extra(expected.select(key), sub.select(key), key).groupBy("issue").count().collect()
    by_issue = {r["issue"]: r["count"] for r in ids}
    n_exp = expected_rows if expected_rows is not None else expected.select(key).distinct().count()
    rows += [
        ("missing_ids", "error", by_issue.get("missing", 0)),
        ("extra_ids", "warning", by_issue.get("extra", 0)),
        ("nan_prices", "error", agg["nan"] or 0),
        ("negative_prices", "error", agg["negative"] or 0),
        ("infinite_prices", "error", agg["infinite"] or 0),
        ("non_positive_prices", "error", agg["non_positive"] or 0),
        ("duplicate_ids", "error", (agg["_n"] or 0) - (agg["_d"] or 0)),
        ("row_count_difference", "error", abs((agg["n_rows"] or 0) - n_exp)),
    ]
    if size_limit is not None:
        size = (agg["_bytes"] or 0) + len(f"{key},{price_col}\n")
        rows.append(("size_over_limit_bytes", "error", max(0, size - size_limit)))
    return spark.createDataFrame(rows, "check string, severity string, n long").withColumn("ok", F.col("n") == 0)


def passed(report: DataFrame) -> bool:
    """Q01: True when no error check failed (warnings allowed)."""
    return report.where((F.col("severity") == "error") & ~F.col("ok")).limit(1).count() == 0
