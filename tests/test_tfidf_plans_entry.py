"""V01-V06 vs a plain-Python statement; plan assertions; driver contract; streaming smoke."""

import math
from collections import Counter

import plain_python as PP
from conftest import SF_SMALL
from pricelab.operators import tfidf as T


def test_tokens_and_tfidf_match_python(spark):
    texts = ["Crème brûlée dessert with fresh cream", "Fresh cream and fresh fruit", "the of and", "",
             "fruit dessert fresh fresh", "café au lait with cream", "Dessert cream fruit", None] * 3
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "sample_id string, catalog_content string")
    got = {r["sample_id"]: list(r["terms"]) for r in T.tokenize(df).collect()}
    for i, t in enumerate(texts):
        assert got[str(i)] == PP.terms(t)
    model = T.fit(df, min_df=2, max_df=0.95, max_features=5)
    docs = [PP.terms(t) for t in texts]
    dfc = Counter(term for d in docs for term in set(d))
    tfc = Counter(term for d in docs for term in d)
    n = len(docs)
    cand = [t for t in tfc if 2 <= dfc[t] <= 0.95 * n]
    top = sorted(sorted(cand), key=lambda t: -tfc[t])[:5]
    vocab = sorted(top)
    assert model.terms() == vocab
    idf = {t: math.log((1 + n) / (1 + dfc[t])) + 1 for t in vocab}
    long = {(r["sample_id"], r["term"]): r["tfidf"] for r in T.transform_long(model, df).collect()}
    for i, d in enumerate(docs):
        c = Counter(x for x in d if x in idf)
        w = {t: c[t] * idf[t] for t in c}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            assert math.isclose(long[(str(i), t)], v / norm, rel_tol=1e-12)
    dense = {r["sample_id"]: r["tfidf"] for r in T.transform_vector(model, df).collect()}
    assert dense["3"] == [0.0] * 5  # empty text -> zero row


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_has_no_python_and_prunes_columns(spark):
    from pricelab.plans.features import engineer_features
    from pricelab.sources.derived import documents_as_catalog

    plan = _plan(engineer_features(documents_as_catalog(spark, SF_SMALL), spread_input=False))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Exchange" not in plan  # narrow: no shuffle
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    # a single-split input is spread once by key before the row work (a no-op for many-split inputs)
    spread_plan = _plan(engineer_features(documents_as_catalog(spark, SF_SMALL)))
    assert spread_plan.count("Exchange hashpartitioning") == 1


def test_metric_plan_is_one_aggregate_with_pushdown(spark):
    from pyspark.sql import functions as F

    from pricelab.operators.metrics import evaluation_record
    from pricelab.session import table

    li = table(spark, SF_SMALL, "lineitem").where(F.col("l_returnflag") == "R")
    p = li.select(F.col("l_extendedprice").alias("y_true"), (F.col("l_extendedprice") * 0.9).alias("pred"))
    plan = _plan(evaluation_record(p))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert plan.count("HashAggregate") == 2  # partial + final of ONE aggregate


def test_pivot_and_broadcast_bounds(spark):
    from pricelab.operators.predictions import stack_wide
    from pricelab.sources.derived import catalog, predictions

    wide = stack_wide(predictions(spark, SF_SMALL), ["catboost", "lightgbm", "neural_net", "xgboost"])
    assert "Exchange" in _plan(wide)
    c = catalog(spark, SF_SMALL)
    tl = T.transform_long(T.fit(c), c)
    assert "BroadcastHashJoin" in _plan(tl)


def test_driver_contract(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    rows = out.collect()
    assert len(rows) >= 1 and {"quantile", "smape", "count"} <= set(out.columns)
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())


def test_small_oracle_subset(spark):
    """A few registered queries equal their DuckDB SQL on sf0.001."""
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("part", "orders", "events", "documents", "lineitem"):
        con.sql(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("v07_features", "a04_smape_by_quantile", "w04_best_so_far", "v04_tfidf_long_documents"):
        s = E.queries()[name](spark, SF_SMALL).toPandas()
        d = con.sql(E.oracle_sql()[name]).df()
        cols = sorted(s.columns)
        assert cols == sorted(d.columns)
        key = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False)))
        assert key(s) == key(d), name


def test_streaming_features(spark):
    from pricelab.streaming.features import stream_features

    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    out = stream_features(spark, SF_SMALL, schema, "text", "doc_id", glob="documents.parquet")
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_udf_runs_without_package_on_workers(tmp_path):
    """Python workers get the package by value: a UDF-using query works from a foreign directory."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from pricelab.operators import tfidf as T\n"
        "df = s.createDataFrame([('1', 'Crème brûlée'), ('2', 'plain text')], 'sample_id string, catalog_content string')\n"
        "print(sorted(r['terms'][0] for r in T.tokenize(df).collect()))\n" % repo
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=300)
    assert "['creme', 'plain']" in out.stdout, out.stderr[-2000:]


def test_stream_over_a_table_of_several_files(spark, tmp_dir):
    from pricelab.streaming.features import stream_features

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")  # a folder, as Spark writes tables
    docs.limit(5).write.parquet(f"{tmp_dir}/other.parquet")
    out = stream_features(spark, tmp_dir, docs.schema, "text", "doc_id", glob="documents.parquet")
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
