"""Catalog text -> one feature row per product, in one projection (no Python UDF).

    sample_id, ipq_value, ipq_unit, ipq_normalized, ipq_unit_type, ipq_confidence, has_ipq,
    text_length, word_count, digit_count, special_char_count, uppercase_ratio, avg_word_length,
    has_quality_keywords, quality_keyword_count, has_discount_keywords, discount_keyword_count,
    has_brand, brand_position, potential_brand  [+ tfidf vector when a fitted model is given]

The work is a narrow transformation: no shuffle, partitions stay as scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ipq import IPQ_FIELDS, ipq_finish, ipq_match
from ..functions.text import (
    BRAND_FIELDS,
    KEYWORD_FIELDS,
    STAT_FIELDS,
    brand_columns,
    clean_text,
    digit_count,
    keyword_columns,
    spaces_to_blank,
    text_stat_columns,
    words_of,
)

FEATURE_COLUMNS = IPQ_FIELDS + STAT_FIELDS + KEYWORD_FIELDS + BRAND_FIELDS


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail before any job when a required column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"DataFrame must contain column(s): {', '.join(missing)}")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a scan that has fewer partitions than the cluster has cores (e.g. a file with a single
    row group) before CPU-heavy row work; a no-op for real inputs, which already come in many splits.
    Hash partitioning on the key keeps retries deterministic."""
    spark = df.sparkSession
    try:
        target = spark.sparkContext.defaultParallelism  # cores of the cluster
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no SparkContext / RDD access (e.g. Spark Connect): leave as is
        return df
    if current >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def engineer_features(
    df: DataFrame,
    text_col: str = "catalog_content",
    id_col: str | None = "sample_id",
    keep: list[str] | tuple[str, ...] = (),
    word_boundary: bool = False,
    spread_input: bool = True,
) -> DataFrame:
    """Feature table. ``keep``: extra input columns carried through (e.g. ``price``).

    Without ``id_col`` the row position is not defined on a distributed table; pass an id.
    """
    require_columns(df, text_col)
    if spread_input and not df.isStreaming:
        df = spread(df, id_col)
    carried = ([id_col] if id_col else []) + list(keep)
    t = clean_text(F.col(text_col))
    # Stage 1: text, lower-case text and blank-normalised text, each once per row.
    s1 = df.select(*[F.col(c) for c in carried], t.alias("_t"), F.lower(t).alias("_low"), spaces_to_blank(t).alias("_b"))
    # Stage 2: the word array and the digit count (shared by statistics, brand and the pattern gate).
    s2 = s1.select(*[F.col(c) for c in carried], "_t", "_low", "_b", words_of(F.col("_b")).alias("_w"),
                   digit_count(F.col("_t")).alias("_d"))
    # Stage 3: pattern match (only texts with a digit can match any pattern), statistics, keywords.
    s3 = s2.select(
        *[F.col(c) for c in carried], "_t", "_w",
        F.when(F.col("_d") > 0, ipq_match(F.col("_low"), word_boundary)).alias("_ipq"),
        *text_stat_columns(F.col("_t"), F.col("_b"), F.col("_w"), F.col("_d")),
        *keyword_columns(F.col("_low")),
    )
    # Stage 4: finish pack quantity, brand from the first five words.
    out = s3.select(
        *[F.col(c) for c in carried],
        *ipq_finish(F.col("_ipq")),
        *[F.col(c) for c in STAT_FIELDS + KEYWORD_FIELDS],
        *brand_columns(F.col("_t"), F.col("word_count"), F.col("_w")),
    )
    return out


def features_with_tfidf(df: DataFrame, model, text_col: str = "catalog_content", id_col: str = "sample_id",
                        keep: list[str] | tuple[str, ...] = (), as_columns: bool = True) -> DataFrame:
    """V07 + J02: the feature row joined (left, on the id) with the TF-IDF vector of a fitted model -
    ``tfidf_0 .. tfidf_{k-1}`` columns, or one array column. The id must be unique (checked first)."""
    from ..operators import tfidf as T
    from ..operators.sets import join_keep_rows

    feats = engineer_features(df, text_col, id_col, keep)
    vec = T.transform_vector(model, df, text_col, id_col)
    if as_columns:
        vec = T.vector_to_columns(vec, model.vocab.count())
    return join_keep_rows(feats, vec, id_col)


def text_statistics(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id") -> DataFrame:
    """F05-F11 only."""
    t = spread(df, id_col).select(F.col(id_col), clean_text(F.col(text_col)).alias("_t"))
    t = t.select(F.col(id_col), "_t", spaces_to_blank(F.col("_t")).alias("_b"))
    t = t.select(F.col(id_col), "_t", "_b", words_of(F.col("_b")).alias("_w"))
    return t.select(F.col(id_col), *text_stat_columns(F.col("_t"), F.col("_b"), F.col("_w")))


def pack_quantity(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
                  word_boundary: bool = False) -> DataFrame:
    """F01-F03 only."""
    low = df.select(F.col(id_col), F.lower(clean_text(F.col(text_col))).alias("_low"))
    return low.select(F.col(id_col), ipq_match(F.col("_low"), word_boundary).alias("_ipq")).select(
        F.col(id_col), *ipq_finish(F.col("_ipq"))
    )


def keywords(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id") -> DataFrame:
    low = df.select(F.col(id_col), F.lower(clean_text(F.col(text_col))).alias("_low"))
    return low.select(F.col(id_col), *keyword_columns(F.col("_low")))


def brands(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id") -> DataFrame:
    t = df.select(F.col(id_col), clean_text(F.col(text_col)).alias("_t"))
    t = t.select(F.col(id_col), "_t", words_of(spaces_to_blank(F.col("_t"))).alias("_w"))
    return t.select(F.col(id_col), *brand_columns(F.col("_t"), F.size("_w"), F.col("_w")))
