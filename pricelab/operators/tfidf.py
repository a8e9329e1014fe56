"""TF-IDF as Spark jobs.

Tokens (V01): lower-case, strip accents (NFKD, drop combining marks), words of >= 2 word characters,
English stop words removed, then unigrams + bigrams of what is left. Regex extraction, the stop-word
set (``StopWordsRemover``, a JVM hash set) and bigrams (``NGram``) stay JVM-side; only accent stripping
needs Python's Unicode tables and runs as an Arrow UDF that receives the text only for non-ASCII rows
(ASCII rows travel as NULL).

Fit (V02, V03): (doc, term) counts -> per term corpus count and document frequency -> drop terms with
df < min_df or df > max_df * n -> top ``max_features`` by count (ties by term) -> vocabulary indexed
alphabetically; idf = ln((1 + n) / (1 + df)) + 1. The vocabulary is at most ``max_features`` rows,
which bounds everything that is broadcast afterwards.

Transform (V04): tokens joined with the broadcast vocabulary (drops non-vocabulary tokens before
any shuffle), counts per (doc, term), tf * idf, L2 row norm; documents without a known term get a zero
row. Long form ``(sample_id, term_index, term, tfidf)`` or a dense vector column (V06).
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import constants as C

TOKEN_RX = r"[\p{L}\p{N}_]{2,}"


def _strip(x):
    if x is None:
        return None
    n = unicodedata.normalize("NFKD", x)
    return "".join(c for c in n if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def _strip_accents_udf(s: pd.Series) -> pd.Series:
    return s.map(_strip, na_action="ignore")


def strip_accents(text):
    """NFKD + drop combining marks; ASCII text is returned unchanged without leaving the JVM."""
    non_ascii = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_strip_accents_udf(F.when(non_ascii, text)), text)


WORD = r"[\p{L}\p{N}_]"


def trie_regex(words: list[str]) -> str:
    """Alternation of ``words`` shaped as a prefix tree, so the regex engine only follows the branch of
    the next character (built by rule from the word list)."""
    import re

    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = True

    def emit(node) -> str:
        end = "" in node
        alts = [re.escape(ch) + emit(node[ch]) for ch in sorted(k for k in node if k)]
        if not alts:
            return ""
        body = alts[0] if len(alts) == 1 and not end else "(?:" + "|".join(alts) + ")"
        return body + ("?" if end else "")

    return emit(root)


def token_regex(stop_words: list[str]) -> str:
    """Maximal runs of >= 2 word characters that are not a stop word."""
    if not stop_words:
        return TOKEN_RX
    return f"(?<!{WORD})(?!(?:{trie_regex(stop_words)})(?!{WORD})){WORD}{{2,}}"


BIGRAM_RX = r"(?:^| )(?=([^ ]+ [^ ]+))"


def kept_words(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
               stop_words: list[str] | None = None) -> DataFrame:
    """(id, words STRING): the kept tokens in text order, joined by blanks (tokens never contain one).

    Stop words are skipped by the token regex itself (a prefix-tree alternation in a negative lookahead).
    This is what is cached where tokens are read several times: shorter than the text, where the arrays
    of terms take several times its size."""
    from ..plans.features import spread

    stop_words = C.ENGLISH_STOP_WORDS if stop_words is None else stop_words
    low = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    base = spread(df, id_col).select(F.col(id_col), strip_accents(low).alias("_s"))
    kept = F.regexp_extract_all(F.col("_s"), F.lit(token_regex(list(stop_words))), 0)
    return base.select(F.col(id_col), F.array_join(kept, " ").alias("words"))


def terms_of(kept: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """(id, terms ARRAY<STRING>) of ``kept_words``: unigrams, then bigrams, which are the overlapping pairs of
    the kept tokens, read by a lookahead regex. All JVM-side."""
    words = F.when(F.col("words") == "", F.array().cast("array<string>")).otherwise(F.split("words", " ", -1))
    return kept.select(F.col(id_col), F.concat(words, F.regexp_extract_all(F.col("words"), F.lit(BIGRAM_RX), 1)).alias("terms"))


def tokenize(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
             stop_words: list[str] | None = None) -> DataFrame:
    """(id, terms ARRAY<STRING>) with unigrams then bigrams, in text order."""
    return terms_of(kept_words(df, text_col, id_col, stop_words), id_col)


def doc_term_counts(terms: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """(id, term, tf) - within-document counts (partial aggregation per (doc, term))."""
    return terms.select(F.col(id_col), F.explode("terms").alias("term")).groupBy(id_col, "term").agg(
        F.count(F.lit(1)).alias("tf"))


@dataclass
class TfidfModel:
    """Fitted vocabulary: ``vocab`` DataFrame (term_index, term, df, idf), at most max_features rows."""

    vocab: DataFrame
    n_docs: int

    def terms(self) -> list[str]:
        return [r["term"] for r in self.vocab.orderBy("term_index").collect()]

    def save(self, path: str) -> None:
        """The vocabulary as a Parquet table (``n_docs`` kept as a column)."""
        self.vocab.withColumn("n_docs", F.lit(self.n_docs)).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TfidfModel":
        v = spark.read.parquet(path)
        n = v.select("n_docs").limit(1).collect()
        if not n:
            raise ValueError(f"empty vocabulary at {path}")
        return TfidfModel(v.drop("n_docs").cache(), int(n[0][0]))


def _term_stats_exact(terms: DataFrame) -> DataFrame:
    tf = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("count"))
    dfc = terms.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return tf.join(dfc, "term")


def _select_vocabulary(stats: DataFrame, n_docs: int, max_features: int, min_df: int, max_df) -> DataFrame:
    max_count = max_df * n_docs if isinstance(max_df, float) else max_df
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_count)))
    return kept


MAX_BROADCAST_HASHES = 100_000


def _words_with(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """The distinct (h, term) of the words whose hash is wanted. The occurrences are not dealt out by their hash, as a
    frequent word's would all go to one task: few hashes are broadcast, for many the words are made distinct first."""
    if wanted.limit(MAX_BROADCAST_HASHES + 1).count() <= MAX_BROADCAST_HASHES:
        return words.join(F.broadcast(wanted.select("h")), "h").distinct()
    return words.distinct().join(wanted.select("h"), "h")


def fit(df: DataFrame | None = None, text_col: str = "catalog_content", id_col: str = "sample_id",
        max_features: int = C.TFIDF_MAX_FEATURES, min_df: int = C.TFIDF_MIN_DF, max_df: float = C.TFIDF_MAX_DF,
        stop_words: list[str] | None = None, terms: DataFrame | None = None, n_docs: int | None = None) -> TfidfModel:
    """V02 + V03. ``terms`` (from ``tokenize``) may be passed to share the tokenization with a transform.

    Counting runs on 64-bit hashes of the terms (fixed-width keys: fast hash aggregation); strings are
    fetched only for the candidates of the top-k, and any hash collision among them falls back to the
    exact string-keyed count."""
    own = None
    if terms is None:
        own = kept_words(df, text_col, id_col, stop_words).persist()  # read by up to three jobs
        terms = terms_of(own, id_col)
    if n_docs is None:
        n_docs = (df if df is not None else terms).count()
    h = F.xxhash64(F.col("term"))
    # every occurrence, and each document's terms once more: both counts from one aggregate
    lists = F.array(F.struct(F.lit(1).alias("occurrence"), F.col("terms").alias("t")), F.struct(F.lit(0).alias("occurrence"), F.array_distinct("terms").alias("t")))
    seen = terms.select(F.explode(lists).alias("l")).select("l.occurrence", F.explode("l.t").alias("term")).select(h.alias("h"), "occurrence")
    counts = seen.groupBy("h").agg(F.sum("occurrence").alias("count"), F.sum(1 - F.col("occurrence")).alias("df"))
    kept = _select_vocabulary(counts, n_docs, max_features, min_df, max_df).persist()
    top = kept.orderBy(F.col("count").desc()).limit(max_features).collect()  # bounded: max_features rows
    if not top:
        kept.unpersist()
        if own is not None:
            own.unpersist()
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    floor = min(r["count"] for r in top)
    words = terms.select(F.explode("terms").alias("term")).select("term", h.alias("h"))
    # Terms above the cut count: fewer than max_features, strings fetched through a broadcast semi join.
    above = kept.where(F.col("count") > floor)
    above_rows = words.join(F.broadcast(above.select("h")), "h").distinct().join(above, "h").collect()
    # Terms at the cut count: possibly many ties; the smallest terms are picked by a distributed
    # top-k, so only the needed ones reach the driver.
    need = max_features - len({r["h"] for r in above_rows})
    tied = kept.where(F.col("count") == floor)
    tied_rows = _words_with(words, tied).join(tied, "h").orderBy("term").limit(need + 1).collect() if need > 0 else []
    kept.unpersist()
    resolved = above_rows + tied_rows
    collision = len({r["h"] for r in above_rows}) != len(above_rows) or len({r["h"] for r in tied_rows}) != len(tied_rows)
    if collision:  # two terms share a 64-bit hash among the candidates: count exactly
        stats = _select_vocabulary(_term_stats_exact(terms), n_docs, max_features, min_df, max_df)
        rows = stats.orderBy(F.col("count").desc(), F.col("term").asc()).limit(max_features).collect()
    else:
        rows = sorted(resolved, key=lambda r: (-r["count"], r["term"]))[:max_features]
    if own is not None:
        own.unpersist()
    ordered = sorted(rows, key=lambda r: r["term"])
    spark = terms.sparkSession
    import math

    vocab = spark.createDataFrame(
        [(i, r["term"], int(r["df"]), int(r["count"]), math.log((1 + n_docs) / (1 + r["df"])) + 1.0)
         for i, r in enumerate(ordered)],
        "term_index int, term string, df long, count long, idf double")
    return TfidfModel(vocab, n_docs)


def transform_long(model: TfidfModel | None, df: DataFrame | None = None, text_col: str = "catalog_content",
                   id_col: str = "sample_id", stop_words: list[str] | None = None, terms: DataFrame | None = None) -> DataFrame:
    """V04 long form: (id, term_index, term, tfidf) for the non-zero entries, L2-normalised per doc.

    Tokens are matched against the broadcast vocabulary (at most max_features rows) before any
    shuffle; the hits are partitioned once by document, which serves both the per-(doc, term) count and
    the per-document norm (window), so there is a single exchange."""
    if model is None:
        raise ValueError("TF-IDF vectorizer not fitted. Call fit() first.")
    from pyspark.sql import Window

    if terms is None:
        terms = tokenize(df, text_col, id_col, stop_words)
    v = F.broadcast(model.vocab.select("term", "term_index", "idf"))
    hits = terms.select(F.col(id_col), F.explode("terms").alias("term")).join(v, "term").repartition(F.col(id_col))
    counts = hits.groupBy(id_col, "term_index", "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
    w = counts.select(id_col, "term_index", "term", (F.col("tf") * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term_index", "term", (F.col("_w") / norm).alias("tfidf"))


def fit_transform(df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
                  **fit_args) -> tuple[TfidfModel, DataFrame]:
    """Fit and transform the same rows, tokenizing once (kept words persisted; unpersist them
    via the returned frame's lineage when done)."""
    kept = kept_words(df, text_col, id_col, fit_args.pop("stop_words", None)).persist()
    terms = terms_of(kept, id_col)
    model = fit(None, text_col, id_col, terms=terms, n_docs=kept.count(), **fit_args)
    return model, transform_long(model, None, text_col, id_col, terms=terms)


def transform_vector(model: TfidfModel, df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
                     stop_words: list[str] | None = None) -> DataFrame:
    """V04 dense form: (id, tfidf ARRAY<DOUBLE> of vocabulary size); zero row when no term is known."""
    k = model.vocab.count()
    long = transform_long(model, df, text_col, id_col, stop_words)
    per_doc = long.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("term_index", "tfidf"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)))
    ids = df.select(F.col(id_col))
    return ids.join(per_doc, id_col, "left").select(id_col, dense.alias("tfidf"))


def vector_to_columns(df: DataFrame, k: int, col: str = "tfidf", prefix: str = "tfidf_") -> DataFrame:
    """Array column -> ``tfidf_0 .. tfidf_{k-1}`` in one select."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, *[F.col(col)[i].alias(f"{prefix}{i}") for i in range(k)])


def id_sequences(model: TfidfModel, df: DataFrame, text_col: str = "catalog_content", id_col: str = "sample_id",
                 length: int = C.ID_SEQUENCE_LENGTH) -> DataFrame:
    """Fixed-length id sequence per text - unigram tokens mapped through the fitted vocabulary
    (index + 2; 1 = unknown; 0 = padding), truncated / padded to ``length``, with an attention mask.

    The vocabulary (at most max_features entries) becomes a map literal, so no join or shuffle."""
    terms = [r["term"] for r in model.vocab.select("term", "term_index").orderBy("term_index").collect()]
    vmap = F.create_map(*[x for i, t in enumerate(terms) for x in (F.lit(t), F.lit(i + 2))])
    low = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    toks = F.regexp_extract_all(strip_accents(low), F.lit(TOKEN_RX), 0)
    x = df.select(F.col(id_col), toks.alias("_tok"))
    ids = F.transform(F.slice("_tok", 1, length), lambda t: F.coalesce(F.try_element_at(vmap, t), F.lit(1)))
    x = x.select(F.col(id_col), ids.alias("_ids"))
    pad = F.array_repeat(F.lit(0), F.lit(length) - F.size("_ids"))
    return x.select(F.col(id_col), F.concat("_ids", pad).alias("input_ids"),
                    F.concat(F.array_repeat(F.lit(1), F.size("_ids")), pad).alias("attention_mask"))
