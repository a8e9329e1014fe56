"""Exact duplicates by deterministic block naming.

The normalised text is cut into blocks of ``BLOCK_BYTES``. All distinct blocks are shuffled by content,
sorted, and named by integers; then the names of adjacent blocks are paired, the distinct pairs sorted and
named in turn, until each document is left with one (level, name). Equal documents get equal names and, as
every name stands for one block or one pair of names, different documents never share one.

Names travel back to the occurrences by the SHA-256 of the block, so the text itself is shuffled once. The
naming step groups by the block's bytes and fails if two different blocks should have the same digest.

Only DataFrame functions; frequent texts are pre-aggregated and joined on plain columns, which adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, body, staged

BLOCK_BYTES = 4096


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(body(text), WHITE, " ")


def _named(pairs: DataFrame, order: list[str]) -> DataFrame:
    """Distinct rows, sorted inside their shuffle partition and numbered: integer names."""
    return pairs.distinct().sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _blocks(documents: DataFrame, block_bytes: int) -> DataFrame:
    text = documents.select("doc_id", normalised().cast("binary").alias("body"))
    sized = text.withColumn("n", F.greatest(F.ceil(F.octet_length("body") / block_bytes), F.lit(1)).cast("int"))
    digest = sized.withColumn("sha", F.unhex(F.sha2("body", 256)))
    cut = F.expr(f"transform(sequence(0, n - 1), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))")
    return digest.select("doc_id", "sha", "n", F.posexplode(cut).alias("i", "block"))


def identities(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, sha, copies, level, name): one row per distinct (doc_id, normalised text).

    ``copies`` counts repeated rows. A null text counts as empty and has one empty block; a null doc_id is
    a value like any other."""
    blocks = _blocks(documents, block_bytes)
    names = _named(blocks.select("block"), ["block"]).select(F.unhex(F.sha2("block", 256)).alias("digest"), "name")
    names = staged(names, "block-names")
    clash = F.raise_error(F.lit("two different blocks have the same SHA-256"))
    names = staged(names.groupBy("digest").agg(F.when(F.count(F.lit(1)) > 1, clash).otherwise(F.min("name")).cast("long").alias("name")), "block-digests")
    spots = blocks.select("doc_id", "sha", "n", "i", F.unhex(F.sha2("block", 256)).alias("digest"))
    level0 = staged(spots.join(names, "digest").select("doc_id", "sha", "n", "i", "name"), "names-0")

    rows = level0.where("i = 0").groupBy("doc_id", "sha", "n").agg(F.count(F.lit(1)).alias("copies"), F.min("name").alias("name"))
    single = rows.where("n = 1").select("doc_id", "sha", "copies", F.lit(0).alias("level"), "name")
    longest = level0.agg(F.max("n")).first()[0] or 1
    current, level, done = level0.where("n > 1"), 0, []
    while longest > 1:
        level += 1
        pairs = current.groupBy("doc_id", "sha", "n", F.expr("i div 2").cast("int").alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
        )
        names = staged(_named(pairs.select("l", "r"), ["l", "r"]), f"pair-names-{level}")
        named = pairs.join(names, ["l", "r"]).select("doc_id", "sha", F.ceil(F.col("n") / 2).cast("int").alias("n"), "i", "name")
        current = staged(named, f"names-{level}")
        done.append(current.where("n = 1").select("doc_id", "sha", F.lit(level).alias("level"), "name"))
        current = current.where("n > 1")
        longest = (longest + 1) // 2
    if not done:
        return single
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    found = found.select(F.col("doc_id").alias("__id"), "sha", "level", "name")
    long_rows = rows.where("n > 1").select("doc_id", "sha", "copies")
    joined = long_rows.join(found, (long_rows.sha == found.sha) & long_rows.doc_id.eqNullSafe(F.col("__id")))
    return single.unionByName(joined.select("doc_id", long_rows.sha, "copies", "level", "name"))


def exact_groups(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the smallest doc_id stays (nulls last); of repeated rows of that doc_id, one. Empty and
    null texts are equal to each other. An empty table gives an empty result; other columns are not read."""
    ids = staged(identities(documents, block_bytes), "identities")
    groups = ids.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups = staged(groups, "identity-groups")
    rows = ids.join(groups, ["level", "name"])
    each = rows.withColumn("__k", F.explode(F.expr("sequence(1L, copies)")))
    return each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__k") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents``, all columns, that stay: of each group the one that ``exact_groups`` keeps; of
    repeated rows one. An empty table stays empty."""
    kept = exact_groups(documents, block_bytes).where("kept").select(F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_sha"))
    rows = documents.select("doc_id", F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("sha"), F.struct("*").alias("row"))
    stay = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (F.col("sha") == F.col("kept_sha")), "left_semi")
    repeated = staged(rows.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated-rows")
    if repeated.isEmpty():
        return stay.select("row.*")
    again = repeated.select(F.col("doc_id").alias("again_id"), F.col("sha").alias("again_sha"))
    on = stay["doc_id"].eqNullSafe(again["again_id"]) & (stay["sha"] == again["again_sha"])
    once = stay.join(again, on, "left_semi").dropDuplicates(["doc_id", "sha"])
    return stay.join(again, on, "left_anti").unionByName(once).select("row.*")
