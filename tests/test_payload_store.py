"""The payload store: batches are published whole or not at all; ingest goes on where it was stopped."""

import base64
import os

import pytest
from pyspark.sql import functions as F

from pricelab.plans import ingest as I
from pricelab.sources import payloads as P

JPEG = b"\xff\xd8\xff" + b"x" * 40 + b"\xff\xd9"


def _url(data: bytes) -> str:
    return "data:image/jpeg;base64," + base64.b64encode(data).decode()


def _files(path):
    return sorted(f for _, _, fs in os.walk(path + "/data") for f in fs)


def test_published_rows_come_back_and_add_up(spark, tmp_dir):
    rows = [(str(i), i % 3 > 0, 1, None if i % 3 else "down", b"a" * i if i % 3 else None) for i in range(50)]
    df = spark.createDataFrame(rows, P.PACK_SCHEMA).repartition(4)
    assert P.published(spark, tmp_dir).count() == 0
    P.publish(df, tmp_dir, pack_bytes=64)
    P.publish(df.limit(0), tmp_dir)
    got = {(r["sample_id"], r["ok"], r["attempts"], r["error"], None if r["content"] is None else bytes(r["content"])) for r in P.published(spark, tmp_dir).collect()}
    assert got == set(rows)
    assert P.scan_payloads(spark, tmp_dir).count() == sum(r[1] for r in rows)
    plan = P.published(spark, tmp_dir).select("sample_id")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_a_killed_task_leaves_nothing(spark, tmp_dir):
    good = spark.createDataFrame([("a", True, 1, None, JPEG)], P.PACK_SCHEMA)
    P.publish(good, tmp_dir)
    before = _files(tmp_dir)

    def dies(batches):
        for pdf in batches:
            yield pdf
            if "39" in set(pdf["sample_id"]):
                os._exit(1)

    many = spark.range(40, numPartitions=4).select(F.col("id").cast("string").alias("sample_id"), F.lit(True).alias("ok"), F.lit(1).alias("attempts"),
                                                   F.lit(None).cast("string").alias("error"), F.lit(JPEG).alias("content"))
    with pytest.raises(Exception):
        P.publish(many.mapInPandas(dies, P.PACK_SCHEMA), tmp_dir, pack_bytes=1)
    assert [r["sample_id"] for r in P.published(spark, tmp_dir).collect()] == ["a"]
    assert _files(tmp_dir) == before and len(os.listdir(tmp_dir + "/commits")) == len([f for f in os.listdir(tmp_dir + "/commits") if f.endswith(".json")]) == 1


def test_commit_removes_what_lost_tasks_have_written(tmp_dir):
    writer = P.PackWriter(tmp_dir, 1)
    os.makedirs(f"{tmp_dir}/data/{writer.batch}")
    for name in ("kept.parquet", "lost.parquet"):
        open(f"{tmp_dir}/data/{writer.batch}/{name}", "wb").close()
    writer.commit([P.PackMessage([("kept.parquet", 1, 1)]), None])
    assert _files(tmp_dir) == ["kept.parquet"]


def test_overwriting_is_an_error(spark, tmp_dir):
    spark.dataSource.register(P.PayloadPacks)
    df = spark.createDataFrame([("a", True, 1, None, JPEG)], P.PACK_SCHEMA)
    with pytest.raises(Exception, match="never overwritten"):
        df.write.format("payload_packs").mode("overwrite").option("path", tmp_dir).save()


def test_ingest_resumes_and_counts(spark, tmp_dir):
    rows = [(str(i), _url(JPEG)) for i in range(23)] + [("bad", _url(b"nope")), ("odd", "http://x"), ("none", None), ("0", _url(JPEG)), (None, _url(JPEG))]
    df = spark.createDataFrame(rows, "sample_id string, image_link string")
    waits = []
    run = lambda **kw: tuple(I.ingest(spark, df, tmp_dir, batch_size=7, max_workers=3, sleep=waits.append, **kw).first())
    assert run(max_items=5) == (5, 0, 21, 26)  # "0", "1", "10", "11", "12"
    assert run() == (18, 3, 5, 26)
    assert run() == (0, 3, 23, 26)
    status = {r["sample_id"]: r for r in P.payload_status(spark, tmp_dir).collect()}
    assert len(status) == 26 and status["0"]["n_batches"] == 1 and status["0"]["n_bytes"] == len(JPEG)
    assert (status["bad"]["attempts"], status["bad"]["error"]) == (6, "corrupted payload")
    assert status["odd"]["error"].startswith("ValueError") and (status["none"]["attempts"], status["none"]["error"]) == (0, "no link")
    assert tuple(I.ingest(spark, df.limit(0), tmp_dir + "/new").first()) == (0, 0, 0, 0)


def test_retries_wait_2_and_4_seconds_and_pass_the_timeout(spark):
    import pandas as pd

    waits, asked = [], []

    def flaky(url, timeout_s):
        asked.append(timeout_s)
        if len(asked) < 3:
            raise TimeoutError("slow")
        return JPEG

    got = next(I.fetch_rows(flaky, 3, waits.append, timeout_s=9.0)(iter([pd.DataFrame({"sample_id": ["x"], "image_link": ["u"]})])))
    assert got.iloc[0].tolist() == ["x", True, 3, None, JPEG] and waits == [2, 4] and asked == [9.0] * 3


def test_batches_are_fetched_together(spark, tmp_dir, monkeypatch):
    """Two batches meet while they are published; an error ends the run, and the next run goes on."""
    import threading

    df = spark.createDataFrame([(str(i), _url(JPEG)) for i in range(10)], "sample_id string, image_link string")
    publish, meet = I.payloads.publish, threading.Barrier(2, timeout=30)

    def together(rows, path, *a):
        meet.wait()
        publish(rows, path, *a)

    with monkeypatch.context() as m:
        m.setattr(I.payloads, "publish", together)
        assert tuple(I.ingest(spark, df.limit(8), tmp_dir, batch_size=4, max_workers=4).first()) == (8, 0, 0, 8)
        m.setattr(I.payloads, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.ingest(spark, df, tmp_dir, batch_size=1)
    assert tuple(I.ingest(spark, df, tmp_dir, batch_size=1).first()) == (2, 0, 8, 10)
