"""Inputs derived by Spark from the provided tables (the catalog, predictions and manifest shapes
the original pipeline works on). Each derivation keeps every row of its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

# FIXED VALUES (model names of the prediction fixture, with their offsets)
MODEL_OFFSETS = [("neural_net", 1), ("lightgbm", 2), ("xgboost", 3), ("catboost", 4)]


def catalog_from_part(part: DataFrame) -> DataFrame:
    """Product catalog ``(sample_id, catalog_content, image_link, price)`` from ``part``.

    NULL and empty texts, every unit spelling, keywords and capitalised first words occur.
    """
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    lead = (
        F.when(k % 5 == 0, "PREMIUM").when(k % 5 == 1, "Deluxe").when(k % 5 == 2, "budget")
        .when(k % 5 == 3, "Sale").otherwise("plain")
    )
    m = k % 16
    qty = (
        F.when(m == 0, F.concat(size, F.lit(" kg"))).when(m == 1, F.concat(size, F.lit("g")))
        .when(m == 2, F.concat(size, F.lit(".5 mg"))).when(m == 3, F.concat(size, F.lit(" l")))
        .when(m == 4, F.concat(size, F.lit("ml"))).when(m == 5, F.concat(size, F.lit(" meters")))
        .when(m == 6, F.concat(size, F.lit(" cm"))).when(m == 7, F.concat(size, F.lit(" mm")))
        .when(m == 8, F.concat(F.lit("pack of "), size)).when(m == 9, F.concat(size, F.lit(" pack")))
        .when(m == 10, F.concat(size, F.lit(" count"))).when(m == 11, F.concat(size, F.lit(" pieces")))
        .when(m == 12, F.concat(size, F.lit("pcs"))).when(m == 13, F.lit("high-quality")).otherwise(F.lit("item"))
    )
    text = (
        F.when(k % 97 == 1, F.lit(None).cast("string")).when(k % 97 == 2, F.lit(""))
        .otherwise(F.concat_ws(" ", lead, F.col("p_name"), F.lower(F.col("p_type")), qty))
    )
    return part.select(
        k.cast("string").alias("sample_id"),
        text.alias("catalog_content"),
        F.concat(F.lit("http://img.example/"), k.cast("string"), F.lit(".jpg")).alias("image_link"),
        F.col("p_retailprice").alias("price"),
    )


def _spread(df: DataFrame, key: str) -> DataFrame:
    from ..plans.features import spread

    return spread(df, key)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_from_part(_spread(table(spark, sf_dir, "part"), "p_partkey"))


def documents_as_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: ``documents`` as (sample_id, catalog_content) - long multilingual texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("sample_id"), F.col("text").alias("catalog_content")
    )


def predictions_from_orders(orders: DataFrame) -> DataFrame:
    """Long prediction table ``(sample_id, model, y_true, pred)``, four models per order.

    The four model rows come from exploding a literal array per order (no join).
    """
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("k")) for m, o in MODEL_OFFSETS])
    key = F.col("o_orderkey")
    x = orders.select(key, F.col("o_totalprice"), F.explode(models).alias("m"))
    noise = (((key * 7919 + F.col("m.k") * 104729) % 401) - 200) / F.lit(1000.0)
    return x.select(
        key.cast("string").alias("sample_id"),
        F.col("m.model").alias("model"),
        F.col("o_totalprice").alias("y_true"),
        (F.col("o_totalprice") * (1 + noise)).alias("pred"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from_orders(_spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey"))


def manifest_from_events(events: DataFrame) -> DataFrame:
    """Checkpoint manifest / metric history ``(stage, checkpoint_type, event_id, ts, metric)``."""
    u = F.col("user_id") % 3
    return events.select(
        F.col("event_type").alias("stage"),
        F.when(u == 0, "quick").when(u == 1, "full").otherwise("minimal").alias("checkpoint_type"),
        F.col("event_id"),
        F.col("ts"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("metric"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_from_events(_spread(table(spark, sf_dir, "events"), "event_id"))


def download_status(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(input ids, completed ids, failed ids) from ``orders``: every order is input; finished
    orders (status F) count as completed downloads and pending ones (status P) as failed."""
    o = table(spark, sf_dir, "orders")
    ids = o.select(F.col("o_orderkey").cast("string").alias("sample_id"),
                   F.concat(F.lit("http://img.example/"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("image_link"))
    done = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    failed = o.filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    return ids, done, failed
