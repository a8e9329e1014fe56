"""Quality classifier: a sparse rule ensemble.

A small random forest is grown on statistics of the labelled texts; every path from a root is a conjunctive
rule; a lasso logistic regression weighs the rules, most of them by zero; the remaining rules are compiled
into one Spark column expression, so scoring is a narrow pass of built-in functions over the whole texts.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, staged

TRAIN_ROWS = 20_000  # most labelled rows that the rules are learned from
TREES, DEPTH, LASSO = 16, 3, 5e-4
HELD_OUT = 1  # crc32(doc_id) mod 3 of rows whose labels are never learned from

Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold) that hold together


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a non-null text by built-in functions; every ratio has a positive denominator."""
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.split(text, r"\s+")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")

    def per_char(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    pairs = F.expr("size(filter(sequence(1, greatest(size(__words) - 1, 1)), i -> get(__words, i) = __words[i - 1]))")
    return {
        "log_chars": F.log1p(F.length(text)),
        "word_length": chars / n_words,
        "upper": per_char(r"\p{Lu}"),
        "digits": per_char(r"\p{N}"),
        "marks": per_char(r"[^\p{L}\p{N}\s]"),
        "mark_runs": per_char(r"[^\p{L}\p{N}\s]{2,}"),
        "pipes": per_char(r"[|<>{}\[\]]"),
        "sentence_ends": F.regexp_count(text, F.lit(r"\p{L}[.!?](?=\s|$)")) / n_words,
        "short_words": F.regexp_count(text, F.lit(r"(?<!\S)\p{L}{1,3}(?!\S)")) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "repeated_neighbours": pairs / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``__s`` of the statistics of its text. It goes through a generator so
    that filters on scores are not pushed below and the statistics are evaluated once a row."""
    text = body()
    split = docs.withColumn("__words", F.split(text, r"\s+"))
    named = F.struct(*[c.cast("double").alias(n) for n, c in statistics(text).items()])
    return split.withColumn("__s", F.explode(F.array(named))).drop("__words")


def tree_rules(printed: str, names: list[str]) -> list[Rule]:
    """Rules of a printed tree: the conjunction above every node but the root; of conditions on one
    statistic and side only the tightest."""
    found: list[Rule] = []
    path: list[tuple[int, str, str, float]] = []  # indentation and condition
    for line in printed.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        while path and path[-1][0] >= len(m[1]):
            path.pop()
        path.append((len(m[1]), names[int(m[2])], m[3], float(m[4])))
        tight: dict[tuple[str, str], float] = {}
        for _, name, side, t in path:
            old = tight.get((name, side), t)
            tight[name, side] = min(old, t) if side == "<=" else max(old, t)
        found.append(tuple(sorted((n, side, t) for (n, side), t in tight.items())))
    return found


def compiled(rule: Rule) -> Column:
    each = [F.col(f"__s.{n}") <= t if s == "<=" else F.col(f"__s.{n}") > t for n, s, t in rule]
    return F.when(reduce(lambda a, b: a & b, each), 1.0).otherwise(0.0)


class RuleEnsemble:
    """Weighted rules and an intercept; ``score`` is the column expression of the probability of label 1."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self) -> Column:
        logit = reduce(lambda a, b: a + b, [F.lit(w) * compiled(r) for r, w in self.rules], F.lit(float(self.intercept)))
        return 1.0 / (1.0 + F.exp(-logit))


def held_out(doc_id: str = "doc_id") -> Column:
    """Null ids hash as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == HELD_OUT


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality") -> RuleEnsemble:
    """Rules from labelled rows that are not held out: all, or TRAIN_ROWS of them by a hash of the id.

    Rows without id, label or document are left out; repeated labels of an id count once (their maximum).
    Where there are no labels, or only one kind, the score is that kind's share (0.5 without any)."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).dropna().where(~held_out("__id"))
    known = known.groupBy("__id").agg(F.max("__y").alias("__y")).orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS)
    texts = documents.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    names = list(statistics(F.lit("")))
    train = with_statistics(texts).select("doc_id", F.col("__y").cast("double").alias("label"), "__s")
    train = staged(train.repartition(8, "doc_id").sortWithinPartitions("doc_id", "__s"), "quality-train")
    kinds = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return RuleEnsemble([], 0.0 if not kinds else (20.0 if 1.0 in kinds else -20.0))
    vectors = train.select("label", "__s", array_to_vector(F.array(*[F.col(f"__s.{n}") for n in names])).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, subsamplingRate=0.8).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString, names)})
    if not rules:
        return RuleEnsemble([], 0.0)
    fired = train.select("label", array_to_vector(F.array(*[compiled(r) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=200).fit(staged(fired, "quality-rules"))
    weights = lasso.coefficients.toArray()
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, weights) if w != 0.0], float(lasso.intercept))


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null and empty texts are scored as empty texts,
    null and repeated doc_ids pass through, an empty table gives an empty result."""
    model = fit(documents, labels)
    rows = with_statistics(documents.select("doc_id", "text"))
    scored = rows.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, that score 0.5 or more; null texts are scored as empty ones,
    repeated rows alike, an empty table stays empty."""
    model = fit(documents, labels)
    rows = with_statistics(documents.select("text", F.struct("*").alias("row")))  # whatever its columns are called
    return rows.withColumn("score", model.score()).where("score >= 0.5").select("row.*")
