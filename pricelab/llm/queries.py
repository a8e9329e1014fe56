"""One query per operator, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .common import documents_of
from .conversation_trie import conversation_trie
from .embedding_dups import near_vectors
from .exact_dedup import exact_groups
from .html_wrappers import extract_text
from .mixing import mixed_words
from .packing import pack_documents
from .quality_rules import score_quality
from .repeats import remove_repeats
from .secret_scan import find_secrets
from .sharding import shard_documents
from .shingle_join import near_groups
from .tokens import count_tokens

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents_of(spark, sf_dir), byte_bpe())


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_words(documents_of(spark, sf_dir))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents_of(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


@query("op4_ngram_jaccard")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents_of(spark, sf_dir))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents_of(spark, sf_dir), byte_bpe())


@query("op6_suffix_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents_of(spark, sf_dir))


OP7_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(c.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""


@query("op7_embedding_dups", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents_of(spark, sf_dir))


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents_of(spark, sf_dir))


OP10_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g USING (body)
"""


@query("op10_exact_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents_of(spark, sf_dir))


# the checksum goes bit by bit: every byte is followed by eight shifts, marked -1
OP11_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT c, ts, [ord(x) FOR x IN string_split(c::VARCHAR, '')] AS codes FROM own),
k AS (SELECT c, ts, xor(list_reduce([4294967295::BIGINT] || flatten([[x::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN codes]),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 4 AS h FROM b),
r AS (SELECT k.c, list_concat(coalesce(base.ts[1:k.h], []), k.ts[k.h + 1:]) AS ts FROM k LEFT JOIN own base ON base.c = k.c - k.c % 20),
p AS (SELECT c, len(ts) AS l, d, ts[1:d] AS pre FROM r, unnest(range(0, len(ts) + 1)) u(d)),
n AS (SELECT pre, d, min(c) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE l = d), '')) AS ends_sha256 FROM p GROUP BY pre, d),
kids AS (SELECT pre[1:d - 1] AS pre, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
  CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.pre[n.d].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN kids ON kids.pre = n.pre),
s AS (SELECT pre[1:u.a] AS pre, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM v, unnest(range(0, v.d + 1)) u(a) GROUP BY 1)
SELECT v.conv_id, v.d::BIGINT AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s ON s.pre = v.pre LEFT JOIN v up ON v.d > 0 AND up.pre = v.pre[1:v.d - 1]
"""


@query("op11_conversation_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g FROM pieces, unnest(range(1, 6)) a(k), unnest(range(1, len(w) + 1)) b(i) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM f WHERE f >= 100),
cand AS (SELECT * FROM often WHERE k > 1),
parts AS (SELECT lang, k, g, f AS a, j, g[1:j] AS head, g[j + 1:] AS rest FROM cand, unnest(range(1, k)) u(j)),
cuts AS (
  SELECT p.*, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * p.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM parts p JOIN often x ON x.lang = p.lang AND x.g = p.head JOIN often y ON y.lang = p.lang AND y.g = p.rest JOIN n ON n.lang = p.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inside AS (
  SELECT c.lang, c.g[i:i + m - 1] AS g, max(c.f) AS f FROM cand c, unnest(range(2, 5)) a(m), unnest(range(1, 5)) b(i)
  WHERE m < c.k AND i + m - 1 <= c.k GROUP BY 1, 2),
kept AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.g = b.g
  WHERE s.f IS NULL OR 100 * s.f < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents_of(spark, sf_dir))


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))
