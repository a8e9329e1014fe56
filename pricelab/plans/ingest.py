"""Resumable ingest of image files as Spark jobs.

Plan of work (I01) = input ids minus ids completed in the manifest minus files already present.
Batches of ``batch_size`` ids (W07) run one after another; inside a batch, ``repartition(max_workers)``
bounds the number of concurrent fetch tasks and ``mapInPandas`` runs the fetch with retries and
exponential backoff (I02, I03). Each batch's results are appended to the Parquet manifest - the commit
point - so a rerun resumes after the last committed batch and a lost executor only repeats its task.

The fetcher is injected (``url -> bytes``); the default reads ``file://`` URLs, there is no network
client here. Files go to ``out_dir``, which must be a folder every executor can write (shared storage).
"""

from __future__ import annotations

import base64
import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import islice

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.sets import pending_work
from ..operators.windows import batch_numbers
from ..session import scratch_path
from ..sources import payloads

RESULT_SCHEMA = "sample_id string, ok boolean, attempts int, error string"


def local_file_fetch(url: str) -> bytes:
    """Default fetcher: ``file://`` (or plain path) URLs only."""
    path = url[len("file://"):] if url.startswith("file://") else url
    with open(path, "rb") as fh:
        return fh.read()


def valid_image_bytes(data: bytes | None) -> bool:
    """The Q06 predicate in Python: JPEG start/end markers or PNG signature, non-empty."""
    if not data:
        return False
    jpeg = data[:3] == b"\xff\xd8\xff" and data[-2:] == b"\xff\xd9"
    png = data[:8] == b"\x89PNG\r\n\x1a\n"
    return jpeg or png


NOT_WRITTEN_YET = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def fetch_partition(fetch: Callable[[str], bytes], out_dir: str, max_retries: int = C.DOWNLOAD_MAX_RETRIES,
                    sleep: Callable[[float], None] = time.sleep, key: str = "sample_id", url_col: str = "image_link"):
    """The per-partition function for ``mapInPandas``: fetch, verify, write, retry after 2, 4, 8 ...
    seconds; one result row per id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for sid, url in zip(pdf[key], pdf[url_col]):
                ok, attempts, err = False, 0, None
                for attempt in range(max_retries):
                    attempts += 1
                    try:
                        data = fetch(url)
                        if valid_image_bytes(data):
                            # a killed task leaves no file under the final name
                            final = os.path.join(out_dir, f"{sid}.jpg")
                            part = f"{final}.{os.getpid()}.part"
                            with open(part, "wb") as fh:
                                fh.write(data)
                            os.replace(part, final)
                            ok, err = True, None
                            break
                        err = "corrupted payload"
                    except Exception as e:  # noqa: BLE001 - any fetch error counts as a failed attempt
                        err = f"{type(e).__name__}: {e}"
                    if attempt < max_retries - 1:
                        sleep(2 ** attempts)
                out.append((sid, ok, attempts, err))
            yield pd.DataFrame(out, columns=["sample_id", "ok", "attempts", "error"])

    return run


def completed_ids(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Ids whose latest manifest record is a success (empty when there is no manifest yet)."""
    try:
        m = spark.read.parquet(manifest_path)
    except AnalysisException as e:
        if e.getCondition() not in NOT_WRITTEN_YET:
            raise
        return spark.createDataFrame([], "sample_id string")
    latest = m.groupBy("sample_id").agg(F.max(F.struct("batch_ts", "ok")).alias("_l"))
    return latest.where(F.col("_l.ok")).select("sample_id")


def existing_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """Ids that already have a file (names only; contents are not read)."""
    from ..sources.images import ID_FROM_PATH

    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,png}").load(out_dir).select("path")
    except AnalysisException as e:
        if e.getCondition() not in NOT_WRITTEN_YET:
            raise
        return spark.createDataFrame([], "sample_id string")
    return files.select(F.regexp_extract("path", ID_FROM_PATH, 1).alias("sample_id"))


def download(spark: SparkSession, inputs: DataFrame, out_dir: str, manifest_path: str,
             fetch: Callable[[str], bytes] = local_file_fetch, batch_size: int = C.DOWNLOAD_BATCH_SIZE,
             max_workers: int = 40, max_retries: int = C.DOWNLOAD_MAX_RETRIES, sleep: Callable[[float], None] = time.sleep,
             max_items: int | None = None) -> DataFrame:
    """Run the ingest; returns the A17 counts ``(success, failed, skipped, total)`` of this run."""
    os.makedirs(out_dir, exist_ok=True)
    todo = pending_work(inputs, completed_ids(spark, manifest_path), existing_files(spark, out_dir))
    total = inputs.count()
    if max_items is not None:
        todo = todo.orderBy("sample_id").limit(max_items)  # T05
    numbered = batch_numbers(todo.select("sample_id", "image_link"), batch_size, ["sample_id"]).persist()
    n_batches = numbered.agg(F.max("batch")).collect()[0][0]
    fn = fetch_partition(fetch, out_dir, max_retries, sleep)
    success = failed = 0
    for b in range(0 if n_batches is None else n_batches + 1):
        part = numbered.where(F.col("batch") == b).select("sample_id", "image_link").repartition(max_workers)
        res = part.mapInPandas(fn, RESULT_SCHEMA).withColumn("batch", F.lit(b)).withColumn("batch_ts", F.current_timestamp())
        res = res.persist()
        res.write.mode("append").parquet(manifest_path)  # commit point of the batch
        c = res.agg(F.sum(F.col("ok").cast("int")).alias("s"), F.count(F.lit(1)).alias("n")).collect()[0]
        success += c["s"] or 0
        failed += (c["n"] or 0) - (c["s"] or 0)
        res.unpersist()
    processed = numbered.count()
    numbered.unpersist()
    return spark.createDataFrame([(success, failed, total - processed, total)],
                                 "success long, failed long, skipped long, total long")


# ---- payloads as rows, published by batch -----------------------------------------------------------
def data_url_fetch(url: str, timeout_s: float | None = None) -> bytes:
    """Fetcher of ``data:`` URLs (base64): the payload is in the URL itself."""
    head, comma, body = url.partition(",")
    if not comma or not head.startswith("data:") or not head.endswith(";base64"):
        raise ValueError("not a base64 data URL")
    return base64.b64decode(body, validate=True)


def fetch_rows(fetch: Callable[[str, float | None], bytes], max_retries: int = C.DOWNLOAD_MAX_RETRIES,
               sleep: Callable[[float], None] = time.sleep, timeout_s: float | None = None):
    """The function for ``mapInPandas`` over (sample_id, image_link): one row of ``PACK_SCHEMA`` per id, handed on
    ``ROWS_HELD`` at a time. A fetch that raises, runs into the timeout (passed on to ``fetch``) or brings no valid payload
    is repeated after 2, 4, 8 ... seconds; an id whose link is NULL fails at once."""

    def one(url):
        if url is None:
            return False, 0, "no link", None
        err = None
        for attempt in range(1, max_retries + 1):
            try:
                data = fetch(url, timeout_s)
                if valid_image_bytes(data):
                    return True, attempt, None, data
                err = "corrupted payload"
            except Exception as e:  # noqa: BLE001 - any fetch error counts as a failed attempt
                err = f"{type(e).__name__}: {e}"
            if attempt < max_retries:
                sleep(2 ** attempt)
        return False, max_retries, err, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), ROWS_HELD):
                part = pdf.iloc[i:i + ROWS_HELD]
                rows = [(sid, *one(url)) for sid, url in zip(part["sample_id"], part["image_link"])]
                yield pd.DataFrame(rows, columns=["sample_id", "ok", "attempts", "error", "content"])

    return run


ROWS_HELD = 64
IN_FLIGHT = 4  # batches of a run that are fetched at a time


def ingest(spark: SparkSession, inputs: DataFrame, path: str, fetch: Callable[[str, float | None], bytes] = data_url_fetch,
           batch_size: int = C.DOWNLOAD_BATCH_SIZE, max_workers: int = 40, max_retries: int = C.DOWNLOAD_MAX_RETRIES,
           sleep: Callable[[float], None] = time.sleep, timeout_s: float | None = None, max_items: int | None = None) -> DataFrame:
    """I01-I04 on the payload store at ``path``: ids that have no good payload yet are fetched in batches of
    ``batch_size`` ids by ``max_workers`` tasks, and each batch is published as a whole. The next run
    goes on where one was stopped. Returns ``(success, failed, skipped, total)`` of this run in ids: an id
    that is listed several times counts once (its smallest link), rows with a NULL id count as nothing.

    The batches are written once as folders, so a batch's job reads its own rows only. ``IN_FLIGHT`` of them are under way
    at a time, as one is too small to fill a cluster, and share the ``max_workers`` tasks; a run that is stopped loses these, no others."""
    ids = inputs.where(F.col("sample_id").isNotNull()).groupBy("sample_id").agg(F.min("image_link").alias("image_link"))
    done = payloads.published(spark, path).where("ok").select("sample_id").distinct()
    todo = ids.join(done, "sample_id", "left_anti")
    if max_items is not None:
        todo = todo.orderBy("sample_id").limit(max_items)  # T05
    plan = scratch_path(spark, "ingest-plan")
    batch_numbers(todo, batch_size, ["sample_id"]).write.partitionBy("batch").parquet(plan)
    numbered = spark.read.schema("sample_id string, image_link string, row_idx long, batch long").parquet(plan)
    last = numbered.agg(F.max("batch")).first()[0]
    fn = fetch_rows(fetch, max_retries, sleep, timeout_s)

    def run(b: int) -> None:
        spark.createDataFrame([], "id int")  # makes the session the thread's own: data sources are looked up there
        part = numbered.where(F.col("batch") == b).select("sample_id", "image_link").repartition(max(1, max_workers // at_once))
        payloads.publish(part.mapInPandas(fn, payloads.PACK_SCHEMA), path)

    at_once = max(1, min(IN_FLIGHT, max_workers))
    todo_batches, under_way = iter(range(0 if last is None else last + 1)), set()
    with ThreadPoolExecutor(at_once) as pool:
        while True:
            under_way |= {pool.submit(inheritable_thread_target(spark)(run), b) for b in islice(todo_batches, at_once - len(under_way))}
            if not under_way:
                break
            ended, under_way = wait(under_way, return_when=FIRST_COMPLETED)
            for job in ended:
                job.result()  # after an error no further batch is begun; those under way end
    after = payloads.published(spark, path).where("ok").select("sample_id").distinct()
    n_todo, n_ok, total = numbered.count(), numbered.join(after, "sample_id", "left_semi").count(), ids.count()
    return spark.createDataFrame([(n_ok, n_todo - n_ok, total - n_todo, total)], "success long, failed long, skipped long, total long")
