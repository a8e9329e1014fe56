"""W01-W03, I05, Q08, F17 over a folder of checkpoint files: the manifest is a table derived from the
file listing (``binaryFile`` metadata only: path, size, modification time - contents are never read),
retention decisions are the W02 window query, and deletion goes through the Hadoop file system API.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.names import metric_from_name
from ..operators.windows import latest_entry, retention_plan

REQUIRED_KEYS = ("state", "stage", "timestamp", "checkpoint_type")


def manifest_from_folder(spark: SparkSession, folder: str, pattern: str = "*.pt") -> DataFrame:
    """``(path, name, stage, checkpoint_type, ts, metric, size_bytes, event_id)`` per checkpoint file.

    Names follow ``<stage>_<type>_<timestamp>[_metric<value>].pt``; the stage is everything before
    ``_<type>_`` (stages may contain underscores). Modification time orders the files, as in the
    original; ``event_id`` is a stable tiebreaker derived from the path."""
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
                 .select("path", "modificationTime", "length"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, name string, stage string, checkpoint_type string, ts timestamp, "
                                         "metric double, size_bytes long, event_id long")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    types = "|".join(C.CHECKPOINT_TYPES)
    parts = rf"^(.*)_({types})_(.*?)(_metric[^_]*)?\.pt$"
    return files.select(
        "path", name.alias("name"),
        F.regexp_extract(name, parts, 1).alias("stage"),
        F.regexp_extract(name, parts, 2).alias("checkpoint_type"),
        F.col("modificationTime").alias("ts"),
        metric_from_name(name).alias("metric"),
        F.col("length").alias("size_bytes"),
        F.xxhash64("path").alias("event_id"),
    )


def check_manifest_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_KEYS) -> None:
    """Q08: a stored manifest / state record must carry the required keys (schema check, no job)."""
    missing = [k for k in required if k not in df.columns]
    if missing:
        raise RuntimeError(f"Checkpoint missing required key(s): {', '.join(missing)}")


def latest_checkpoint(manifest: DataFrame, stage: str | None = None) -> str | None:
    """Path of the newest checkpoint, overall or of one stage; None when there is none."""
    m = manifest if stage is None else manifest.where(F.col("stage") == stage)
    r = latest_entry(m.select("ts", "event_id", "path"), by=()).collect()
    return r[0]["path"] if r and r[0]["path"] is not None else None


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp) and fs.delete(hp, False):
            n += 1
    return n


def apply_retention(spark: SparkSession, folder: str, keep_n: int = C.MAX_CHECKPOINTS_TO_KEEP, dry_run: bool = False) -> DataFrame:
    """Keep the newest ``keep_n`` per (stage, type) plus the best by metric; delete the rest.

    The decision is one distributed window query; the paths to delete (bounded by the number of
    checkpoint files, which retention keeps small) are removed through the file system API."""
    plan = retention_plan(manifest_from_folder(spark, folder), keep_n)
    doomed = [r["path"] for r in plan.where(~F.col("keep")).select("path").collect()]
    deleted = 0 if dry_run else _delete(spark, doomed)
    return spark.createDataFrame([(len(doomed), deleted)], "to_delete long, deleted long")


def clear_stage(spark: SparkSession, folder: str, stage: str) -> int:
    """Delete every checkpoint of one stage; returns how many were deleted."""
    m = manifest_from_folder(spark, folder).where(F.col("stage") == stage)
    return _delete(spark, [r["path"] for r in m.select("path").collect()])
