"""S01-S15, Q01-Q07, I01-I04 with fixture C6 (binary files written to a temporary folder)."""

import os

import pytest

from pricelab.plans import ingest as I
from pricelab.plans import submission as SUB
from pricelab.sources import images as IM
from pricelab.sources import store as ST

JPEG = b"\xff\xd8\xff\xe0" + b"x" * 50 + b"\xff\xd9"
PNG = b"\x89PNG\r\n\x1a\n" + b"y" * 20


def _files(folder):
    payloads = {"a": JPEG, "b": JPEG[:-2], "c": b"corrupted_data", "d": b"", "e": PNG}
    for k, v in payloads.items():
        ext = "png" if k == "e" else "jpg"
        with open(os.path.join(folder, f"{k}.{ext}"), "wb") as fh:
            fh.write(v)
    return payloads


def test_image_scan_and_integrity(spark, tmp_dir):
    _files(tmp_dir)
    files = IM.scan_images(spark, tmp_dir)
    ids = spark.createDataFrame([(k,) for k in "abcdef"], "sample_id string")
    got = {r["sample_id"]: (r["status"], r["reason"]) for r in IM.verify_images(files, ids).collect()}
    assert got == {"a": ("valid", None), "b": ("corrupted", "bad_bytes"), "c": ("corrupted", "bad_bytes"),
                   "d": ("corrupted", "no_file"), "e": ("valid", None), "f": ("corrupted", "no_file")}
    fb = {r["sample_id"]: r["is_fallback"] for r in IM.with_fallback(ids, files).collect()}
    assert fb == {"a": False, "b": True, "c": True, "d": True, "e": False, "f": True}


def test_download_retry_resume(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    good = {f"id{i}": JPEG for i in range(12)}
    for k, v in good.items():
        with open(os.path.join(src, f"{k}.jpg"), "wb") as fh:
            fh.write(v)
    rows = [(k, f"file://{src}/{k}.jpg") for k in good] + [("bad", f"file://{src}/missing.jpg")]
    inputs = spark.createDataFrame(rows, "sample_id string, image_link string")
    out, manifest = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "manifest")
    delays = []
    stats = I.download(spark, inputs, out, manifest, batch_size=5, max_workers=3, sleep=delays.append).collect()[0]
    assert (stats["success"], stats["failed"], stats["total"]) == (12, 1, 13)
    m = spark.read.parquet(manifest)
    bad = m.where("sample_id = 'bad'").collect()[0]
    assert bad["attempts"] == 3 and not bad["ok"]
    # resume: nothing done twice, the failed id is retried
    stats2 = I.download(spark, inputs, out, manifest, batch_size=5, max_workers=3, sleep=lambda s: None).collect()[0]
    assert (stats2["success"], stats2["failed"], stats2["skipped"]) == (0, 1, 12)
    assert m.where("ok").groupBy("sample_id").count().where("count > 1").count() == 0


def test_backoff_grows():
    calls = []
    fn = I.fetch_partition(lambda url: (_ for _ in ()).throw(IOError("down")), "/nonexistent", 3, calls.append)
    import pandas as pd

    res = list(fn(iter([pd.DataFrame({"sample_id": ["x"], "image_link": ["u"]})])))[0]
    assert res["attempts"][0] == 3 and calls == [2, 4]


def test_submission_checks(spark):
    sub = spark.createDataFrame([("1", 5.0), ("2", float("nan")), ("3", -1.0), ("3", float("inf")), ("9", 1.0)],
                                "sample_id string, price double")
    exp = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "sample_id string")
    rep = {r["check"]: r["n"] for r in SUB.validation_report(sub, exp).collect()}
    assert rep["missing_ids"] == 1 and rep["extra_ids"] == 1 and rep["nan_prices"] == 1
    assert rep["negative_prices"] == 1 and rep["infinite_prices"] == 1 and rep["duplicate_ids"] == 1
    assert not SUB.passed(SUB.validation_report(sub, exp))
    size = {r["check"]: r["n"] for r in SUB.validation_report(sub, exp, size_limit=10).collect()}["size_over_limit_bytes"]
    assert size > 0
    built = SUB.build_submission(spark.createDataFrame([(1, 2.0), (2, -3.0)], "sample_id int, pred double"), from_log_space=True)
    vals = sorted(r["price"] for r in built.collect())
    assert vals[0] == 0.0 and vals[1] > 6.0


def test_prediction_store_partition_pruning(spark, tmp_dir):
    rows = [(str(i), 1.0, 1.0, m, s) for i in range(10) for m in ("a", "b") for s in ("train", "validation")]
    df = spark.createDataFrame(rows, ST.PRED_SCHEMA)
    ST.save_predictions(df, tmp_dir + "/store")
    sel = ST.load_predictions(spark, tmp_dir + "/store", model="a", split="train")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "model" in plan
    assert sel.count() == 10
    with pytest.raises(FileNotFoundError):
        ST.select_source(spark, tmp_dir + "/store", "zzz")


def test_corrupt_json_progress_is_ignored(spark, tmp_dir):
    p = tmp_dir + "/progress"
    os.makedirs(p)
    with open(p + "/part-0.json", "w") as fh:
        fh.write('{"batch": 0, "completed": ["a", "b"], "failed": ["c"]}\n{not json\n')
    got = {r["sample_id"]: r["status"] for r in ST.read_progress(spark, p).collect()}
    assert got == {"a": "completed", "b": "completed", "c": "failed"}


def test_checkpoint_folder_retention(spark, tmp_dir):
    """W01/W02/I05/Q08 on real files: newest 3 per (stage, type) + best metric kept, other stage untouched."""
    import time as _t

    from pricelab.sources import checkpoints as CK

    for i in range(6):
        metric = 1.0 if i == 1 else 10.0 - i
        name = f"neural_net_quick_2024-01-01T00-00-0{i}_metric{metric:.4f}.pt"
        with open(os.path.join(tmp_dir, name), "wb") as fh:
            fh.write(b"x" * (i + 1))
        os.utime(os.path.join(tmp_dir, name), (1_700_000_000 + i, 1_700_000_000 + i))
    for i in range(2):
        with open(os.path.join(tmp_dir, f"gbdt_full_2024-01-01T00-00-0{i}.pt"), "wb") as fh:
            fh.write(b"y")
    _t.sleep(0.01)
    m = CK.manifest_from_folder(spark, tmp_dir)
    assert {r["stage"] for r in m.collect()} == {"neural_net", "gbdt"}
    assert CK.latest_checkpoint(m, "neural_net").endswith("00-00-05_metric5.0000.pt")
    res = CK.apply_retention(spark, tmp_dir).collect()[0]
    assert (res["to_delete"], res["deleted"]) == (2, 2)
    left = sorted(os.listdir(tmp_dir))
    assert "neural_net_quick_2024-01-01T00-00-01_metric1.0000.pt" in left  # best kept
    assert sum(f.startswith("gbdt") for f in left) == 2
    assert CK.clear_stage(spark, tmp_dir, "gbdt") == 2
    with pytest.raises(RuntimeError):
        CK.check_manifest_columns(m)


def test_schema_level_helpers(spark):
    from pricelab.operators import profile as P

    a = spark.createDataFrame([(1, "x", 1.0, True)], "ipq_value int, text_length string, tfidf_0 double, has_brand boolean")
    b = spark.createDataFrame([(1, 2.0)], "ipq_value int, other double")
    groups = {r["column_group"]: r["n_columns"] for r in P.column_groups(a).collect()}
    assert groups == {"ipq": 1, "text": 1, "tfidf": 1, "has": 1}
    issues = {(r["issue"], r["column"]) for r in P.column_alignment(a, b).collect()}
    assert ("missing_in_train", "other") in issues and ("missing_in_test", "tfidf_0") in issues
    assert P.numeric_columns(a) == ["ipq_value", "tfidf_0"]


def test_injected_decoder(spark, tmp_dir):
    _files(tmp_dir)
    files = IM.scan_images(spark, tmp_dir)
    got = {r["sample_id"]: r["decodable"] for r in IM.verify_with_decoder(files, I.valid_image_bytes).collect()}
    assert got == {"a": True, "b": False, "c": False, "e": True}  # the empty file is not listed by the source


def test_approximate_quantile_edges(spark):
    import numpy as np

    from pricelab.operators import metrics as M

    rng = np.random.default_rng(5)
    t = rng.uniform(1, 1000, 2000)
    df = spark.createDataFrame([(float(a), float(a * 1.1)) for a in t], "y_true double, pred double")
    exact = {r["quantile"]: r["count"] for r in M.smape_by_quantile(df).collect()}
    approx = {r["quantile"]: r["count"] for r in M.smape_by_quantile(df, approx=True).collect()}
    assert sum(approx.values()) == 2000 and set(approx) == set(exact)
    assert all(abs(approx[q] - exact[q]) <= 20 for q in exact)
