"""A store of fetched payloads, written by a Python data source that publishes a batch on commit.

A task packs the payloads it gets into Parquet files of about ``PACK_BYTES`` under ``data/<batch>/`` and tells the
driver their names, rows and bytes. The driver publishes them by one small file under ``commits/``, renamed into place
when complete. Readers open published packs only, so what a lost task, a repeated task or a failed batch has written
is never seen; commit and abort remove it. Millions of small payloads become a few large files that Spark scans by
bytes, reading the payload column only where it is asked for.

The folder may be any that Arrow's file systems open (``file:``, ``hdfs:``, ``s3:``, ...) and must be shared by the
driver and all executors.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

PACK_BYTES = 64 << 20
PACK_SCHEMA = "sample_id string, ok boolean, attempts int, error string, content binary"


def _open_folder(path: str):
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return system, root.rstrip("/")


def _remove_unlisted(system, folder: str, keep: set[str]) -> None:
    """Removes the files of a batch that are not published."""
    from pyarrow import fs

    for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if f.is_file and f.base_name not in keep:
            system.delete_file(f.path)


@dataclass
class PackMessage(WriterCommitMessage):
    """What a task has written: (file name, rows, payload bytes) per pack."""

    packs: list


class PackWriter(DataSourceArrowWriter):
    def __init__(self, path: str, pack_bytes: int):
        self.path, self.pack_bytes = path, pack_bytes
        self.batch = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # names sort by time

    def write(self, iterator) -> PackMessage:
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, root = _open_folder(self.path)
        folder = f"{root}/data/{self.batch}"
        system.create_dir(folder, recursive=True)
        packs, held, size = [], [], 0

        def flush():
            nonlocal held, size
            if held:
                name = f"{uuid.uuid4().hex}.parquet"
                table = pa.Table.from_batches(held)
                with system.open_output_stream(f"{folder}/{name}") as out:
                    pq.write_table(table, out)
                packs.append((name, table.num_rows, size))
                held, size = [], 0

        for rows in iterator:
            held.append(rows)
            size += rows.nbytes
            if size >= self.pack_bytes:
                flush()
        flush()
        return PackMessage(packs)

    def commit(self, messages) -> None:
        system, root = _open_folder(self.path)
        packs = [p for m in messages if m is not None for p in m.packs]
        system.create_dir(f"{root}/commits", recursive=True)
        hidden = f"{root}/commits/.{self.batch}"
        with system.open_output_stream(hidden) as out:
            out.write("".join(json.dumps({"batch": self.batch, "file": f, "n_rows": n, "n_bytes": b}) + "\n" for f, n, b in packs).encode())
        system.move(hidden, f"{root}/commits/{self.batch}.json")
        _remove_unlisted(system, f"{root}/data/{self.batch}", {p[0] for p in packs})

    def abort(self, messages) -> None:
        system, root = _open_folder(self.path)
        _remove_unlisted(system, f"{root}/data/{self.batch}", set())


class PayloadPacks(DataSource):
    """``df.write.format("payload_packs").mode("append").option("path", ...).save()`` with the columns of
    ``PACK_SCHEMA``; option ``packBytes`` sets the size of a pack."""

    @classmethod
    def name(cls) -> str:
        return "payload_packs"

    def schema(self) -> str:
        return PACK_SCHEMA

    def writer(self, schema, overwrite: bool) -> PackWriter:
        if overwrite:
            raise ValueError("published payloads are added to, never overwritten")
        return PackWriter(self.options["path"], int(self.options.get("packbytes", PACK_BYTES)))


_REGISTERING = threading.Lock()


def publish(rows: DataFrame, path: str, pack_bytes: int = PACK_BYTES) -> None:
    """One batch: the rows (``PACK_SCHEMA``) become visible together, or not at all."""
    with _REGISTERING:  # batches may be published by several threads
        rows.sparkSession.dataSource.register(PayloadPacks)
    cols = [f.split()[0] for f in PACK_SCHEMA.split(", ")]
    rows.select(*cols).write.format("payload_packs").mode("append").option("path", path).option("packBytes", pack_bytes).save()


def published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published batches with their ``batch`` (names sort by time); no rows before the first one. The
    driver sees the names of the packs, one per about ``PACK_BYTES``, as a file listing would give it."""
    from pyarrow import fs

    system, root = _open_folder(path)
    names = []
    for f in system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
        if f.base_name.endswith(".json") and not f.base_name.startswith("."):
            with system.open_input_stream(f.path) as src:
                names += [(r["batch"], r["file"]) for r in map(json.loads, src.read().decode().splitlines())]
    if not names:
        return spark.createDataFrame([], PACK_SCHEMA + ", batch string")
    base = path.rstrip("/")
    packs = spark.read.schema(PACK_SCHEMA).parquet(*[f"{base}/data/{b}/{f}" for b, f in names])
    return packs.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+)/[^/]+$", 1))


def payload_status(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, ok, attempts, error, n_bytes, n_batches) per id: ``ok`` and ``n_bytes`` from its good payload if it has one,
    ``error`` of its latest batch otherwise, ``attempts`` over all batches."""
    rows = published(spark, path).select("sample_id", "ok", "attempts", "error", "batch", F.octet_length("content").alias("n_bytes"))
    g = rows.groupBy("sample_id").agg(F.max("ok").alias("ok"), F.sum("attempts").cast("int").alias("attempts"), F.max_by("error", "batch").alias("_e"),
                                      F.max(F.when(F.col("ok"), F.col("n_bytes"))).alias("n_bytes"), F.countDistinct("batch").alias("n_batches"))
    return g.select("sample_id", "ok", "attempts", F.when(~F.col("ok"), F.col("_e")).alias("error"), "n_bytes", "n_batches")


def scan_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The good payloads as (sample_id, path, length, content), the columns of ``images.scan_images``."""
    ok = published(spark, path).where("ok")
    return ok.select("sample_id", F.concat_ws("/", "batch", "sample_id").alias("path"), F.octet_length("content").cast("long").alias("length"), "content")
