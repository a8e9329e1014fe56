"""Reproducible splits by key hash (stable under any partitioning, no sort, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .windows import decile_labels, hash_bucket, running_scan
from .groups import join_groups

SPLIT_BUCKETS = 1000


def split_bucket(key, seed: int = C.RANDOM_STATE):
    return hash_bucket(key, seed, SPLIT_BUCKETS)


def train_val_split(df: DataFrame, key: str = "sample_id", share: float = C.VALIDATION_SHARE,
                    seed: int = C.RANDOM_STATE, col: str = "split") -> DataFrame:
    """``split`` = 'validation' for a seeded hash bucket below ``share``, else 'train'.

    The same key always lands on the same side, in every stage and on every cluster."""
    b = split_bucket(F.col(key), seed)
    return df.withColumn(col, F.when(b < int(round(share * SPLIT_BUCKETS)), F.lit("validation")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, value: str = "price", key: str = "sample_id", share: float = C.VALIDATION_SHARE,
                     seed: int = C.RANDOM_STATE, n_strata: int = 10, col: str = "split") -> DataFrame:
    """Per price decile, the ``round(share * n)`` rows with the smallest key hash go to validation.

    Ranks inside each stratum come from the partition-parallel running scan (a decile holds a tenth
    of the rows; no stratum is processed by a single task)."""
    lab = decile_labels(df, value, n_strata).withColumn(
        "_h", F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(key).cast("string"))))
    sized = lab.groupBy("decile").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_scan(lab, ["_h", key], by=["decile"])
    out = join_groups(ranked, sized, ["decile"], "left")  # one row per stratum on the right
    is_val = F.col("_rn") <= F.floor(F.col("_n") * share + 0.5)  # round half up
    return out.select(*df.columns, "decile", F.when(is_val, "validation").otherwise("train").alias(col))


def shuffle_order(df: DataFrame, key: str = "sample_id", seed: int = C.RANDOM_STATE) -> DataFrame:
    """A seeded shuffled order (sort by a key hash)."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))


def train_val_test_split(df: DataFrame, key: str = "sample_id", val_share: float = C.VALIDATION_SHARE,
                         test_share: float = C.VALIDATION_SHARE, seed: int = C.RANDOM_STATE, col: str = "split") -> DataFrame:
    """X01 with a held-out test side: buckets [0, v) validation, [v, v + t) test, the rest train."""
    b = split_bucket(F.col(key), seed)
    v = int(round(val_share * SPLIT_BUCKETS))
    t = int(round(test_share * SPLIT_BUCKETS))
    return df.withColumn(col, F.when(b < v, F.lit("validation")).when(b < v + t, F.lit("test")).otherwise(F.lit("train")))
