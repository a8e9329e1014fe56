"""From raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and is written as Parquet
and read again before the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelab.llm.common import documents_of, staged
from pricelab.llm.exact_dedup import drop_exact_duplicates
from pricelab.llm.mixing import mixed_documents
from pricelab.llm.packing import pack_documents
from pricelab.llm.quality_rules import keep_good
from pricelab.llm.queries import byte_bpe
from pricelab.llm.shingle_join import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.5 go; it is learned from ``labels``."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that each source gives to the mix; documents drawn twice are two rows."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 1024 tokens."""
    return pack_documents(docs, byte_bpe())


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mixture), ("packing", packed)]
ORACLE_SQL = None  # trees, lasso weights, draws and tokens are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{i}")
    return docs
