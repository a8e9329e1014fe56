"""Registered queries: TF-IDF (V01-V06) on the catalog and on whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import splits as X
from ..operators import tfidf as T
from ..oracle.fixtures import with_fixtures
from ..oracle.sqlfeatures import q
from ..registry import r6, register, rounded
from ..sources.derived import catalog, documents_as_catalog

_STOP = "[" + ", ".join(q(w) for w in C.ENGLISH_STOP_WORDS) + "]"
_SPLIT = "case when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 100 then 'validation' else 'train' end"


def _terms_sql(src: str, name: str = "terms") -> str:
    return f""", {name}_tok as (select sample_id, regexp_extract_all(strip_accents(lower(coalesce(catalog_content, ''))), {q(T.TOKEN_RX)}) as t from {src}),
{name}_kept as (select sample_id, list_filter(t, lambda x: not list_contains({_STOP}, x)) as k from {name}_tok),
{name} as (select sample_id, list_concat(k, list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) as terms from {name}_kept)
"""


def _vocab_sql(src: str) -> str:
    return _terms_sql(src, "fterms") + f""", dtc as (select sample_id, term, count(*) as tf from (select sample_id, unnest(terms) as term from fterms) group by all),
st as (select term, cast(sum(tf) as bigint) as count, count(*) as df from dtc group by term),
nd as (select count(*) as n from {src}),
top as (select term, count, df from st, nd where df >= 5 and df <= 0.95 * nd.n order by count desc, term asc limit 100),
vocab as (select cast(row_number() over (order by term) - 1 as integer) as term_index, term, df, count,
            ln((1 + nd.n) / (1 + df)) + 1 as idf from top, nd)
"""


def _long_sql(src: str) -> str:
    return _terms_sql(src, "tterms") + """, hits as (select t.sample_id, v.term_index, v.term, v.idf, count(*) as tf
          from (select sample_id, unnest(terms) as term from tterms) t join vocab v on v.term = t.term group by all),
w as (select sample_id, term_index, term, tf * idf as w from hits),
nrm as (select sample_id, sqrt(sum(w * w)) as norm from w group by sample_id),
long as (select w.sample_id, term_index, term, w / norm as tfidf from w join nrm on nrm.sample_id = w.sample_id)
"""


@register("v01_tokens", with_fixtures(_terms_sql("catalog") +
                                      "select sample_id, cast(len(terms) as integer) as n_terms, array_to_string(terms, '|') as terms from terms"))
def v01_tokens(spark, sf_dir):
    """Unigram + bigram terms of every catalog text (accents stripped, stop words removed)."""
    t = T.tokenize(catalog(spark, sf_dir))
    return t.select("sample_id", F.size("terms").alias("n_terms"), F.array_join("terms", "|").alias("terms"))


@register("v01_tokens_documents", with_fixtures(_terms_sql("docs") +
                                                "select sample_id, cast(len(terms) as integer) as n_terms, array_to_string(terms, '|') as terms from terms"))
def v01_tokens_documents(spark, sf_dir):
    """V01 over whole multilingual documents (accent stripping exercised)."""
    t = T.tokenize(documents_as_catalog(spark, sf_dir))
    return t.select("sample_id", F.size("terms").alias("n_terms"), F.array_join("terms", "|").alias("terms"))


@register("v02_vocabulary", with_fixtures(_vocab_sql("catalog") +
                                          "select term_index, term, df, count, " + r6("idf") + " as idf from vocab"))
def v02_vocabulary(spark, sf_dir):
    """V02 + V03: fitted vocabulary (min_df 5, max_df 0.95, top 100 by count) with smoothed idf."""
    return rounded(T.fit(catalog(spark, sf_dir)).vocab)


@register("v02_vocabulary_documents", with_fixtures(_vocab_sql("docs") +
                                                    "select term_index, term, df, count, " + r6("idf") + " as idf from vocab"))
def v02_vocabulary_documents(spark, sf_dir):
    """V02 + V03 fitted on whole documents."""
    return rounded(T.fit(documents_as_catalog(spark, sf_dir)).vocab)


@register("v04_tfidf_long", with_fixtures(_vocab_sql("catalog") + _long_sql("catalog") +
                                          "select sample_id, term_index, term, " + r6("tfidf") + " as tfidf from long"))
def v04_tfidf_long(spark, sf_dir):
    """L2-normalised tf-idf entries of every catalog text (long form)."""
    _model, long = T.fit_transform(catalog(spark, sf_dir))
    return rounded(long)


@register("v04_tfidf_long_documents", with_fixtures(_vocab_sql("docs") + _long_sql("docs") +
                                                    "select sample_id, term_index, term, " + r6("tfidf") + " as tfidf from long"))
def v04_tfidf_long_documents(spark, sf_dir):
    """V04 on whole documents."""
    _model, long = T.fit_transform(documents_as_catalog(spark, sf_dir))
    return rounded(long)


@register("v05_fit_train_apply_validation", with_fixtures(
    f", train as (select * from catalog where {_SPLIT} = 'train'), val as (select * from catalog where {_SPLIT} = 'validation')"
    + _vocab_sql("train") + _long_sql("val") + "select sample_id, term_index, term, " + r6("tfidf") + " as tfidf from long"))
def v05_fit_train_apply_validation(spark, sf_dir):
    """Vocabulary fitted on the train split, applied to the validation split."""
    c = X.train_val_split(catalog(spark, sf_dir))
    model = T.fit(c.where(F.col("split") == "train"))
    return rounded(T.transform_long(model, c.where(F.col("split") == "validation")))


def _v06_sql() -> str:
    cols = ", ".join(r6(f"coalesce(sum(case when l.term_index = {i} then l.tfidf end), 0.0)") + f" as tfidf_{i}" for i in range(100))
    return (_vocab_sql("catalog") + _long_sql("catalog") +
            f"select c.sample_id, {cols} from catalog c left join long l on l.sample_id = c.sample_id group by c.sample_id")


@register("v06_tfidf_columns", with_fixtures(_v06_sql()))
def v06_tfidf_columns(spark, sf_dir):
    """V04 dense + V06: one ``tfidf_i`` column per vocabulary term, zero rows for unknown texts."""
    c = catalog(spark, sf_dir)
    model = T.fit(c)
    k = model.vocab.count()
    return rounded(T.vector_to_columns(T.transform_vector(model, c), k))


def _j02_sql() -> str:
    from ..oracle.sqlfeatures import features_select

    cols = ", ".join(r6(f"coalesce(sum(case when l.term_index = {i} then l.tfidf end), 0.0)") + f" as tfidf_{i}" for i in range(100))
    return (_vocab_sql("catalog") + _long_sql("catalog")
            + f", vec as (select c.sample_id, {cols} from catalog c left join long l on l.sample_id = c.sample_id group by c.sample_id)"
            + f", feats as (select * from ({features_select('catalog', keep=('price',))}))"
            + " select feats.*, " + ", ".join(f"vec.tfidf_{i}" for i in range(100))
            + " from feats left join vec on vec.sample_id = feats.sample_id")


@register("j02_features_with_tfidf", with_fixtures(_j02_sql()))
def j02_features_with_tfidf(spark, sf_dir):
    """V07 + J02 + V06: 19 features and 100 tf-idf columns per product (left join on the unique id)."""
    from ..plans.features import features_with_tfidf

    c = catalog(spark, sf_dir)
    return rounded(features_with_tfidf(c, T.fit(c), keep=["price"]), skip=("price", "ipq_value", "ipq_normalized",
                                                                         "ipq_confidence", "uppercase_ratio",
                                                                         "avg_word_length", "brand_position"))
