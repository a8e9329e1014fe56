"""Readers and writers - CSV, Parquet feature store, partitioned prediction store,
JSON progress records, sample and timestamped outputs. Explicit schemas everywhere (no inference)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

RAW_SCHEMA = StructType([
    StructField("sample_id", StringType()), StructField("catalog_content", StringType()),
    StructField("image_link", StringType()), StructField("price", DoubleType()),
])
TEST_SCHEMA = StructType([f for f in RAW_SCHEMA.fields if f.name != "price"])
PRED_SCHEMA = StructType([
    StructField("sample_id", StringType()), StructField("y_true", DoubleType()), StructField("pred", DoubleType()),
    StructField("model", StringType()), StructField("split", StringType()),
])
PROGRESS_SCHEMA = StructType([
    StructField("batch", LongType()), StructField("completed", ArrayType(StringType())),
    StructField("failed", ArrayType(StringType())),
])


def read_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, null_marker: str | None = None) -> DataFrame:
    """Quoted, multi-line CSV with a header, parsed with an explicit schema.

    By default an empty field is NULL (what a pandas reader does). Files written by ``write_csv`` with
    a ``null_marker`` keep NULL and empty text apart when read with the same marker."""
    r = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
    if null_marker is not None:
        r = r.option("nullValue", null_marker)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite", null_marker: str | None = None) -> None:
    """Header, no index; one file only when asked (``coalesce(1)`` funnels through one task)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("header", True).option("escape", '"')
    if null_marker is not None:
        w = w.option("nullValue", null_marker)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink (the feature store)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_fingerprint(df: DataFrame) -> tuple[int, int, int]:
    """(rows, sum, sum) of a table, whatever the order of its rows and columns, in one aggregate: the halves of the
    rows' 128-bit hashes added up as exact decimals. A changed, dropped, doubled or added row changes it; NULL, NaN
    and empty text are told apart, and so are values of different columns. No rows give (0, 0, 0)."""
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}))
    half = lambda i: F.sum(F.conv(F.substring(row, i, 16), 16, 10).cast("decimal(28,0)"))
    n, a, b = df.agg(F.count(F.lit(1)), half(1), half(17)).first()
    return int(n), int(a or 0), int(b or 0)


def round_trip_differences(a: DataFrame, b: DataFrame) -> tuple[int, int]:
    """S04 check: rows of a not in b and of b not in a (multiset difference both ways). Equal fingerprints, one pass
    over each table, settle it; only tables that differ are shuffled to count how."""
    cols = sorted(a.columns)
    a, b = a.select(*[f"`{c}`" for c in cols]), b.select(*[f"`{c}`" for c in cols])
    if table_fingerprint(a) == table_fingerprint(b):
        return 0, 0
    return a.exceptAll(b).count(), b.exceptAll(a).count()


def save_predictions(preds: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Prediction store partitioned by model and split (directory layout = partition columns)."""
    preds.write.mode(mode).partitionBy("model", "split").parquet(path)


def load_predictions(spark: SparkSession, path: str, model: str | None = None, split: str | None = None) -> DataFrame:
    """Read the store; model / split filters prune partitions (no other directory is read)."""
    df = spark.read.schema(PRED_SCHEMA).parquet(path)
    if model is not None:
        df = df.where(F.col("model") == model)
    if split is not None:
        df = df.where(F.col("split") == split)
    return df


def select_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One prediction source by model name; error if it is not in the store."""
    df = load_predictions(spark, path, model=source)
    if not df.limit(1).collect():
        raise FileNotFoundError(f"no predictions for source {source!r} under {path}")
    return df


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level partition column, from the directory listing (no data file is opened)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return []
    prefix = column + "="
    out = []
    for st in fs.listStatus(hp):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.append(_unescape(name[len(prefix):]))
    return sorted(out)


def _unescape(v: str) -> str:
    from urllib.parse import unquote

    return unquote(v)


def available_models(spark: SparkSession, path: str, expected: list[str]) -> DataFrame:
    """Expected models with a presence flag, from the store's partition directories."""
    present = set(partition_values(spark, path, "model"))
    return spark.createDataFrame([(m, m in present) for m in expected], "model string, present boolean")


def write_progress(batches: DataFrame, path: str, mode: str = "append") -> None:
    """Progress as JSON lines, one record per batch (arrays bounded by the batch size)."""
    batches.write.mode(mode).json(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, status) from the JSON progress records; corrupt lines are dropped
    (PERMISSIVE with no corrupt-record column: they parse to NULL arrays and explode to nothing)."""
    raw = spark.read.schema(PROGRESS_SCHEMA).option("mode", "PERMISSIVE").json(path)
    done = raw.select(F.explode(F.array_distinct("completed")).alias("sample_id"), F.lit("completed").alias("status"))
    fail = raw.select(F.explode(F.array_distinct("failed")).alias("sample_id"), F.lit("failed").alias("status"))
    both = done.unionByName(fail).distinct()
    # an id that completed in any batch is completed
    return both.groupBy("sample_id").agg(F.min("status").alias("status"))


def write_sample(df: DataFrame, path: str, key: str = "sample_id", n: int = 100, null_marker: str | None = None) -> None:
    """The first ``n`` rows by key, as a CSV for inspection (top-k, not a full sort)."""
    write_csv(df.orderBy(key).limit(n), path, single_file=True, null_marker=null_marker)


def write_timestamped(df: DataFrame, base: str, name: str = "submission", now: _dt.datetime | None = None) -> tuple[str, str]:
    """Write ``<base>/<name>_<timestamp>`` (must not exist) and ``<base>/<name>_latest`` (overwritten)
    from the same cached frame."""
    ts = (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")
    stamped, latest = f"{base}/{name}_{ts}", f"{base}/{name}_latest"
    cached = df.persist()
    write_csv(cached, stamped, mode="errorifexists")
    write_csv(cached, latest, mode="overwrite")
    cached.unpersist()
    return stamped, latest

