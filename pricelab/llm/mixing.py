"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of ``BLOCK_WORDS`` words. A source's words are drawn in a keyed random order
of its blocks; a source whose target exceeds its size is drawn again in another order (an epoch). The
number of blocks each source gives is exact, and a binary tree over the output shards splits these quotas:
each node draws how many blocks of every source go left (multivariate hypergeometric, seeded by the
node), so that every shard has its exact size and all shards together exactly the quotas. A shard's share
of a source is a range of that source's order, so draws are disjoint; each shard shuffles its own blocks.

Orders are computed by hash buckets per source, so no task holds a whole source; the driver sees one number
per source.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, WORD, body, key_of, ranked, staged, unused

BLOCK_WORDS = 64
SHARD_BLOCKS = 16_384  # blocks of one output shard
BUCKETS = 1024  # per source and epoch
GRANULE = 1024  # draws of a source that are matched to shards together
TOP_NODES = 256  # nodes of the tree that the driver opens; Spark opens the rest
SMALL_TABLE = 100_000  # sources up to which the table of targets is broadcast
TAILS = 12  # standard deviations of a draw within which all but 10^-30 of the probability lies


def targets(sizes: list[int], total_share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = (5, 2, 1)) -> list[float]:
    """Words to take of each source (in their order): ``total_share`` of all words by repeating weights;
    no target exceeds ``cap`` times its source, what is cut off is shared out among the others."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    limit = [cap * s for s in sizes]
    out = [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), total_share * sum(sizes)
    while open_:
        share = sum(weight[i] for i in open_)
        over = [i for i in open_ if left * weight[i] / share > limit[i]]
        if not over:
            for i in open_:
                out[i] = left * weight[i] / share
            break
        for i in over:
            out[i] = limit[i]
        left -= sum(limit[i] for i in over)
        full = set(over)
        open_ = [i for i in open_ if i not in full]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without return are good, by inversion: the probabilities around the mode follow
    from the ratios of neighbours, so totals of any size are drawn the same way."""
    low, high = max(n - bad, 0), min(n, good)
    if low == high:
        return low
    total = good + bad
    p, q = good / total, n / total
    reach = int(TAILS * math.sqrt(total * p * (1 - p) * q * (1 - q))) + 64
    mode = min(max((good + 1) * (n + 1) // (total + 2), low), high)
    up, down = np.arange(mode, min(mode + reach, high), dtype=float), np.arange(mode, max(mode - reach, low), -1, dtype=float)
    above = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    below = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    share = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    return mode - len(below) + int(np.searchsorted(share, rng.random() * share[-1], side="right"))


def split(lo: int, hi: int, shards: int, total: int, start: list[int], quota: list[int], seed: int):
    """The two halves of the node of shards lo..hi-1: (lo, hi, start, quota) each. ``start`` is the first
    draw of every source in the node, ``quota`` how many it holds."""
    mid = (lo + hi) // 2
    left = total * mid // shards - total * lo // shards
    rng = np.random.default_rng([seed, lo, hi])
    rest, taken = sum(quota), []
    for q in quota:
        rest -= q
        taken.append(hypergeometric(rng, q, rest, left) if left else 0)
        left -= taken[-1]
    yield lo, mid, list(start), taken
    yield mid, hi, [s + t for s, t in zip(start, taken)], [q - t for q, t in zip(quota, taken)]


def shard_ranges(spark, quota: list[int], shards: int, seed: int) -> DataFrame:
    """(source, shard, first, n): the range of each source's draws that each shard takes."""
    total = sum(quota)
    nodes = [(0, shards, [0] * len(quota), quota)]
    while len(nodes) < TOP_NODES and any(hi - lo > 1 for lo, hi, _, _ in nodes):
        nodes = [c for lo, hi, s, q in nodes for c in (split(lo, hi, shards, total, s, q, seed) if hi - lo > 1 else [(lo, hi, s, q)])]

    def leaves(frames):
        for frame in frames:
            for node in frame.itertuples(index=False):
                stack = [(int(node.lo), int(node.hi), [int(x) for x in node.start], [int(x) for x in node.quota])]
                while stack:
                    lo, hi, s, q = stack.pop()
                    if hi - lo > 1:
                        stack += split(lo, hi, shards, total, s, q, seed)
                    else:
                        yield pd.DataFrame({"source_no": np.arange(len(q)), "shard": lo, "first": s, "n": q}).query("n > 0")

    frame = spark.createDataFrame(nodes, "lo long, hi long, start array<long>, quota array<long>")
    return frame.repartition(min(len(nodes), 64)).mapInPandas(leaves, "source_no long, shard long, first long, n long")


def mix(documents: DataFrame, total_share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = (5, 2, 1), seed: int = 17, row_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, draws).

    ``rows``: every row with source_no, row (its number in the source), id (the column ``row_id``, if given, else
    a number of its own), doc_id, size, source_size, target.
    ``draws``: the mix, one row per drawn block: shard, position there, source_no, row, doc_id, epoch,
    first word, n_words (the last draw of a source is cut to end at its target, rounded).

    A null source is one source, the last; null and empty texts have no words and are never drawn; null
    doc_ids and repeated rows are rows like others; empty tables give empty results."""
    spark = documents.sparkSession
    size = F.regexp_count(body(), F.lit(WORD)).cast("long")
    base = documents.select("doc_id", "source", key_of("source").alias("skey"), size.alias("size"), F.xxhash64(body()).alias("h"),
                            (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("id"))
    base = staged(base, "mix-rows")
    per_source = base.groupBy("skey", "source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    sources = per_source.orderBy(F.col("source").asc_nulls_last()).collect()  # one row per source
    sizes = [r["size"] for r in sources]
    target = targets(sizes, total_share, cap, weights)
    quota = [math.floor(t + 0.5) for t in target]
    plan = spark.createDataFrame(
        [(r["skey"], i, n, t, q, math.ceil(q / n) if n else 0) for i, (r, n, t, q) in enumerate(zip(sources, sizes, target, quota))],
        "skey string, source_no long, source_size long, target double, quota long, epochs int",
    )
    plan = F.broadcast(plan) if len(sources) <= SMALL_TABLE else plan
    buckets = int(min(sum(r["rows"] for r in sources) // 1024 + 1, BUCKETS))
    rows = staged(ranked(base, "skey", ["doc_id", "h"], ["doc_id", "h", "size", "id"], buckets, "row").join(plan, "skey"), "mix-numbered")

    # blocks in the order of each epoch: hash bucket, then hash
    block = rows.where("size > 0").select("source_no", "source_size", "quota", "row", "doc_id", "size", F.explode(F.expr("sequence(0, epochs - 1)")).alias("epoch"))
    block = block.withColumn("block", F.explode(F.expr(f"sequence(0L, (size - 1) div {BLOCK_WORDS})")))
    block = block.withColumn("first", F.col("block") * BLOCK_WORDS).withColumn("n", F.least(F.lit(BLOCK_WORDS), F.col("size") - F.col("first")))
    block = block.withColumn("h", F.xxhash64(F.lit(seed), "epoch", "source_no", "row", "block")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    cap_words: Column = F.least("source_size", F.col("quota") - F.col("epoch") * F.col("source_size"))
    block = block.withColumn("cap", cap_words).drop("size", "source_size", "quota")
    key = ["source_no", "epoch", "bucket"]
    sums = block.groupBy(*key).agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("blocks"))
    before = Window.partitionBy("source_no", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words0"), F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("blocks0"))
    inside = Window.partitionBy(*key).orderBy("h", "row", "block")
    drawn = block.withColumn("i", F.row_number().over(inside) - 1).withColumn("w", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    drawn = drawn.join(sums, key).withColumn("w", F.col("w") + F.col("words0")).where("w < cap")
    drawn = drawn.select("source_no", "epoch", "row", "doc_id", "first", F.least("n", F.col("cap") - F.col("w")).alias("n_words"), (F.col("blocks0") + F.col("i")).alias("i"), "h")
    drawn = staged(drawn, "mix-draws")
    counts = {(r["source_no"], r["epoch"]): r["n"] for r in drawn.groupBy("source_no", "epoch").agg(F.count(F.lit(1)).alias("n")).collect()}  # a few per source
    given, shift = [0] * len(sources), []
    for (s, e), n in sorted(counts.items()):  # epochs in order: what earlier ones of the source gave
        shift.append((s, e, given[s]))
        given[s] += n
    shift = spark.createDataFrame(shift, "source_no long, epoch int, shift long")
    shift = F.broadcast(shift) if len(sources) <= SMALL_TABLE else shift
    drawn = drawn.join(shift, ["source_no", "epoch"]).withColumn("pos", F.col("shift") + F.col("i")).drop("shift", "i")

    shards = max(math.ceil(sum(given) / SHARD_BLOCKS), 1)
    ranges = shard_ranges(spark, given, shards, seed)
    # each draw takes the last range that begins at or before it; ranges are marked in every granule they touch
    marks = ranges.withColumn("granule", F.explode(F.expr(f"sequence(first div {GRANULE}, (first + n - 1) div {GRANULE})")))
    marks = marks.select("source_no", "granule", F.greatest("first", F.col("granule") * GRANULE).alias("pos"), F.lit(0).alias("kind"), "shard")
    both = drawn.withColumn("granule", F.expr(f"pos div {GRANULE}")).withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    last = Window.partitionBy("source_no", "granule").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    dealt = both.withColumn("shard", F.last("shard", ignorenulls=True).over(last)).where("kind = 1")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "h"), "source_no", "row", "first", "epoch")
    dealt = dealt.withColumn("position", F.row_number().over(local) - 1)
    return rows, dealt.select("shard", "position", "source_no", "row", "doc_id", "epoch", F.col("first").alias("first_word"), "n_words")


def mixed_words(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, blocks, first_shard, first_position of every row: the
    words and blocks that the mix takes of it and where the earliest of them stands."""
    rows, draws = mix(documents, **options)
    first = F.min(F.struct("shard", "position"))
    taken = draws.groupBy("source_no", "row").agg(F.sum("n_words").alias("taken"), F.count(F.lit(1)).alias("blocks"), first.alias("at"))
    out = rows.join(taken, ["source_no", "row"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", zero).alias("taken"), F.coalesce("blocks", zero).alias("blocks"),
        F.col("at.shard").alias("first_shard"), F.col("at.position").alias("first_position"),
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix as documents, all columns: one row per document and epoch with the drawn words as its text
    (the text itself where all are drawn) and ``n_chars``, if there, counted anew. Rows that the mix takes
    nothing of are gone. Rows are told apart by a number, so repeated rows, null ids and columns of any name do
    no harm; an empty table gives an empty one."""
    number, words, parts, whole = unused(documents, "mix_row", "mix_words", "mix_parts", "mix_whole")
    docs = staged(documents.withColumn(number, F.monotonically_increasing_id()), "mix-documents")
    rows, draws = mix(docs, row_id=number, **options)
    part = draws.groupBy("source_no", "row", "epoch").agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias(parts), F.sum("n_words").alias("n"))
    part = part.join(rows.select("source_no", "row", "id", "size"), ["source_no", "row"])
    part = part.select(F.col("id").alias(number), parts, (F.col("n") == F.col("size")).alias(whole))
    both = docs.join(part, number)
    both = both.withColumn(words, F.when(~F.col(whole), F.filter(F.split("text", WHITE), lambda w: w != "")))
    cut = F.expr(f"array_join(flatten(transform(`{parts}`, p -> slice(`{words}`, cast(p.first_word + 1 as int), cast(p.n_words as int)))), ' ')")
    both = both.withColumn("text", F.when(F.col(whole), F.col("text")).otherwise(cut))
    if "n_chars" in documents.columns:
        both = both.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return both.select(*[F.col(f"`{c}`") for c in documents.columns])
