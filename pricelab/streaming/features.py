"""The feature expressions on a streaming DataFrame.

The original has no streaming; this shows that the stateless feature projection (V07) runs unchanged
under Structured Streaming: a file source, the same ``engineer_features`` plan, a Parquet sink with a
checkpoint location, and an ``availableNow`` trigger that processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans.features import engineer_features
from ..session import scratch_path


def _pattern(name: str) -> str:
    """``name`` as a pattern: of a path without any, the file source wants a folder, and the table may be one file."""
    return name if any(c in name for c in "*?[{") else f"{name[:-1]}[{name[-1]}]"


def stream_features(spark: SparkSession, source_dir: str, schema: StructType, text_col: str, id_col: str,
                    glob: str | None = None, sink: str | None = None, checkpoint: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the feature stream to completion (``availableNow``) and return the sink table. ``glob`` names files of
    ``source_dir``, or folders that hold a table's files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(f"{source_dir.rstrip('/')}/{_pattern(glob)}" if glob else source_dir)
    feats = engineer_features(src, text_col, id_col)
    sink = sink or scratch_path(spark, "stream-features")
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    q = (feats.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)
