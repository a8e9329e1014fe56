"""checkpoint file-name parts as expressions (stem, stage prefix test, metric suffix)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def checkpoint_name(stage: Column, ctype: Column, ts_text: Column, metric: Column) -> Column:
    """``<stage>_<type>_<timestamp with ':' as '-'>[_metric<4 decimals>].pt``."""
    suffix = F.when(metric.isNotNull(), F.concat(F.lit("_metric"), F.format_string("%.4f", metric))).otherwise(F.lit(""))
    return F.concat(stage, F.lit("_"), ctype, F.lit("_"), F.regexp_replace(ts_text, ":", "-"), suffix, F.lit(".pt"))


def stem(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)


def has_stage_prefix(name: Column, stage: str) -> Column:
    return name.startswith(stage + "_")


def metric_from_name(name: Column) -> Column:
    """Number after ``_metric`` up to ``.pt``; text that is not a number gives NULL (``try_cast``)."""
    raw = F.regexp_extract(name, r"_metric(.*?)\.pt$", 1)
    return F.when(raw != "", raw.try_cast("double"))


