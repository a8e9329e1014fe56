"""The pipeline's stages: clashing and odd inputs, empty tables, and the whole run against plain rules."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pricelab.llm.exact_dedup import drop_exact_duplicates
from pricelab.llm.mixing import mixed_words
from pricelab.llm.quality_rules import keep_good, score_quality
from pricelab.llm.shingle_join import drop_near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, sha string, h string, id int, key int, score int, __s int"
SF = "/root/testdata/sf0.001"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", None, "r", "s", "h", 1, 2, 3, 4) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    base = " ".join(f"word{i}" for i in range(60))
    return [(1, base), (2, base.replace(" ", "  ", 1)), (3, base + " more"), (3, base + " more"), (4, None), (5, ""), (None, base), (None, "alone here"), (6, "quite another text of many words")]


def test_filters_keep_all_columns_of_any_name(spark, rows):
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)], "doc_id long, quality int, toxic int")
    for out, want in [(drop_exact_duplicates(docs), [1, 3, 4, 6, None]), (drop_near_duplicates(docs), None), (keep_good(docs, labels), None)]:
        assert out.columns == docs.columns
        got = out.collect()
        assert all(tuple(r)[5:] == ("r", "s", "h", 1, 2, 3, 4) for r in got)
        assert {(r["doc_id"], r["text"]) for r in got} <= set(rows)
        if want:
            assert sorted((r["doc_id"] for r in got), key=str) == sorted(want, key=str)
    near = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()]
    assert len(near) == len(rows) - 4 and (1, rows[0][1]) in near and (None, "alone here") in near


def test_empty_tables(spark, rows):
    empty = make(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (drop_exact_duplicates(empty), drop_near_duplicates(empty), keep_good(empty, labels), score_quality(empty, labels)):
        assert out.collect() == []
    assert score_quality(make(spark, rows), labels).where("score = 0.5").count() == len(rows)


def test_run_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = kept.select("doc_id", "text").collect()
        kept = stage(spark, kept, SF).persist()
        if name == "quality classifier":
            scores = {r["doc_id"]: r["predicted"] for r in score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            assert {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p == 1}
        elif name == "exact dedup":
            plain = {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                plain.setdefault(" ".join(r["text"].split()), r["doc_id"])
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(plain.values())
        elif name == "n-gram Jaccard join":
            sets = {r["doc_id"]: (lambda w: frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))))(r["text"].lower().split()) for r in before}
            root = {i: i for i in sets}

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i

            ids = sorted(sets)
            for a in ids:
                for b in ids:
                    if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in ids if find(i) == i)
        elif name == "mixing":
            source = spark.createDataFrame(before).join(docs.select("doc_id", "source"), "doc_id")
            want = sum(r["taken"] for r in mixed_words(source).collect())
            got = kept.collect()
            assert sum(len(r["text"].split()) for r in got) == want and {r["doc_id"] for r in got} <= {r["doc_id"] for r in before}
        else:
            held = kept.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
            assert all(r["n"] == r["end"] <= 1024 for r in held)
            assert Counter(r["doc_id"] for r in kept.where("start = 0").collect()) == Counter(r["doc_id"] for r in before)
        if name != "packing":
            assert kept.columns == columns
