"""What the fit keeps and deals out."""

from pyspark.sql import functions as F

from pricelab.operators import tfidf as T


def test_words_are_cached_not_their_terms(spark, monkeypatch):
    cached, persist = [], type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: cached.append(self.columns) or persist(self, *a))
    df = spark.createDataFrame([("1", "red apple red apple"), ("2", "red Crème"), ("3", None), ("4", "the")], "sample_id string, catalog_content string")
    model = T.fit(df, max_features=2, min_df=1)
    assert ["sample_id", "terms"] not in cached and ["sample_id", "words"] in cached
    assert model.terms() == ["apple", "red"]
    got = {r.sample_id: r.terms for r in T.tokenize(df).collect()}
    assert got == {"1": ["red", "apple", "red", "apple", "red apple", "apple red", "red apple"], "2": ["red", "creme", "red creme"], "3": [], "4": []}


def test_ties_at_the_cut(spark, monkeypatch):
    """However many terms tie, the smallest are taken; occurrences are not shuffled by term."""
    rows = [(str(i), f"word{i:02d} word{i:02d} common") for i in range(30)]
    df = spark.createDataFrame(rows, "sample_id string, catalog_content string")
    want = ["common", "common common"][:1] + ["word00", "word01", "word02"]
    assert T.fit(df, max_features=4, min_df=1, max_df=1.0).terms() == want
    words = T.tokenize(df).select(F.explode("terms").alias("term")).select("term", F.xxhash64("term").alias("h"))
    monkeypatch.setattr(T, "MAX_BROADCAST_HASHES", 2)
    wanted = words.where("term like 'word%' and term not like '% %'").select("h").distinct()
    assert T.fit(df, max_features=4, min_df=1, max_df=1.0).terms() == want
    assert sorted(r.term for r in T._words_with(words, wanted).collect()) == [f"word{i:02d}" for i in range(30)]
