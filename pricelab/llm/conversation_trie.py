"""Prefix trie of conversations by fixed-length block hashing.

Conversations are put in order, rebuilt (every one starts with the first turns of its group's base
conversation) and cut into blocks of ``BLOCK`` turns. A prefix is named by 128 bits: the sum, lane by lane, of
the hashes of (position, turn), so the names of all block ends are running sums. Conversations are grouped by
(prefix before the block, prefix after it) first. Only where several different blocks follow the same prefix
do their turns get grouped one by one; elsewhere a block is a chain with one set of members.

A node is owned by its smallest member, and what a conversation owns is the end of its path, so (conv_id,
depth) names a node and the trie is a set of chains hung on chains. Sums over subtrees are taken over the
chains by doubling (logarithmic in how deep chains hang) and then along each chain in segments.

No step holds a conversation, a group of copies or a node's members in one task: positions come from one range
partitioned sort, running sums from segments, groups from partial aggregates. The one sequential step is the
SHA-256 of a node's member list, whose ids are first joined to texts of up to ``ENDS`` ids.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged

BLOCK = 4  # turns of a block
SEGMENT = 4096  # turns whose running sums one window task takes at a time
GROUP = 20  # conversations that share the start of the smallest id's conversation
HEADS = 4  # a conversation takes fewer than this many turns from its base
ENDS = 4096  # width of the id ranges that member lists are joined by
LANES = ("l0", "l1", "l2", "l3")
MASK = (1 << 32) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def lanes(digest: Column) -> list[Column]:
    """Four 32-bit parts of a hexadecimal digest as longs; sums of 2^31 of them do not overflow."""
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(n) for i, n in enumerate(LANES)]


def name_of(l0: Column, l1: Column, l2: Column, l3: Column) -> Column:
    """The 128-bit name of a prefix from its four sums."""
    half = [c.bitwiseAND(F.lit(MASK)) for c in (l0, l1, l2, l3)]
    return F.struct(F.shiftleft(half[0], 32).bitwiseOR(half[1]).alias("a"), F.shiftleft(half[2], 32).bitwiseOR(half[3]).alias("b"))


def lane_sum(turns: Column, lane: str) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + t[lane])


def ordered_turns(conversations: DataFrame, name: str) -> DataFrame:
    """(conv_id, place, digest, words): ``place`` rises with the order inside a conversation, and rows of one
    conversation in one partition of the sort have consecutive places."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    sort = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.repartitionByRange(*sort, F.substring("text", 1, 64)).sortWithinPartitions(*sort, F.col("text"))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    return staged(dealt.select("conv_id", F.monotonically_increasing_id().alias("place"), digest.alias("digest"),
                               F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), name)


def rebuilt_turns(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, digest, words) of the rebuilt conversations, (conv_id, turns) of all of them)."""
    parts = turns.groupBy("conv_id", F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    own = own.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    bases = own.where("conv_id = base").select("base", F.col("own").alias("base_own"))
    convs = own.join(bases, "base", "left").withColumn("given", F.least("h", F.coalesce("base_own", F.lit(0))))
    convs = convs.select("conv_id", "base", "h", "given", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    convs = staged(convs, "trie-convs")
    known = parts.select("conv_id", "part", "first", "start").join(convs.select("conv_id", "h", "given"), "conv_id")
    placed = turns.withColumn("part", F.shiftright("place", 33)).join(known, ["conv_id", "part"])
    placed = placed.withColumn("pos", F.col("start") + F.col("place") - F.col("first"))
    kept = placed.where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "digest", "words")
    lent = placed.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads - 1)).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    lent = lent.join(convs.where("given > 0").select("conv_id", "base", "given"), "base").where("pos < given")
    return kept.unionByName(lent.select("conv_id", "pos", "digest", "words")), convs.select("conv_id", "turns")


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, block, before, after, nodes): the blocks of every conversation with the names of the prefixes
    before and after, and per turn the name of the prefix that it ends and its words."""
    hashed = turns.withColumn("d", F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest"))))
    hashed = hashed.select("conv_id", (F.col("pos") / BLOCK).cast("long").alias("block"), F.struct("pos", *lanes(F.col("d")), "words").alias("t"))
    rows = hashed.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))  # at most BLOCK turns
    rows = rows.withColumn("segment", (F.col("block") * BLOCK / SEGMENT).cast("long"))
    for n in LANES:
        rows = rows.withColumn(n, lane_sum(F.col("ts"), n))
    # whole segments before this one: only conversations of more than SEGMENT turns have any
    sums = rows.groupBy("conv_id", "segment").agg(*[F.sum(n).bitwiseAND(F.lit(MASK)).alias(n) for n in LANES])
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "segment", *[F.sum(n).over(earlier).alias(f"o{n}") for n in LANES]).where("segment > 0")
    inside = Window.partitionBy("conv_id", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("conv_id", "segment", "block", "ts", *LANES, *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"b{n}") for n in LANES])
    rows = rows.join(offsets, ["conv_id", "segment"], "left")
    start = [F.col(f"b{n}") + F.coalesce(F.col(f"o{n}"), F.lit(0)) for n in LANES]
    upto = [F.col(f"s{n}") for n in LANES]
    rows = rows.select("conv_id", "block", "ts", *[s.alias(f"s{n}") for s, n in zip(start, LANES)], *LANES)
    nodes = F.transform(F.sequence(F.lit(1), F.size("ts")), lambda k: F.struct(
        name_of(*[u + lane_sum(F.slice("ts", F.lit(1), k), n) for u, n in zip(upto, LANES)]).alias("id"),
        F.element_at("ts", k)["words"].alias("words")))
    return rows.select("conv_id", "block", name_of(*upto).alias("before"), nodes.alias("nodes")).withColumn("after", F.element_at("nodes", -1)["id"])


def trie_nodes(blocks: DataFrame) -> DataFrame:
    """(id, up, conv_id, depth, n_convs, words) of every node but the root."""
    classes = blocks.groupBy("block", "before", "after").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("nodes").alias("nodes"))
    classes = staged(classes, "trie-classes")
    forks = classes.where("block > 0").groupBy("before").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("before", F.lit(True).alias("forks"))
    later = classes.where("block > 0").join(forks, "before", "left")
    marked = classes.where("block = 0").withColumn("forks", F.lit(True)).unionByName(later)

    def turn_rows(df: DataFrame) -> DataFrame:
        up = F.expr("if(i = 0, before, nodes[i - 1].id)")
        rows = df.select("block", "before", "n", "low", "nodes", F.posexplode("nodes").alias("i", "t"))
        return rows.select(F.col("t.id").alias("id"), up.alias("up"), F.col("low").alias("conv_id"), (F.col("block") * BLOCK + F.col("i") + 1).alias("depth"),
                           F.col("n").alias("n_convs"), F.col("t.words").alias("words"))

    chains = turn_rows(marked.where("forks is null"))
    refined = turn_rows(marked.where("forks")).groupBy("id", "up", "depth").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("words").alias("words"))
    return chains.unionByName(refined)


def ends_of(finals: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, conv_id): SHA-256 of the ids that share a final node, ascending."""
    texts = finals.groupBy("id", F.floor(F.col("conv_id") / ENDS).alias("range")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    texts = staged(texts, "trie-ends")
    many = texts.groupBy("id").agg(F.count(F.lit(1)).alias("m"), F.first("ids").alias("ids"))
    single = many.where("m = 1").select("id", F.sha2("ids", 256).alias("ends_sha256"))

    def stream(batches):
        now, digest = None, None
        for batch in batches:
            done_id, done = [], []
            for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if now != (a, b):
                    if now is not None:
                        done_id.append(now)
                        done.append(digest.hexdigest())
                    now, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield record(done_id, done)
        if now is not None:
            yield record([now], [digest.hexdigest()])

    def record(ids, hashes):
        return pa.RecordBatch.from_arrays([pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64()), pa.array(hashes, pa.string())], ["a", "b", "ends_sha256"])

    long = texts.join(many.where("m > 1").select("id"), "id", "left_semi").select(F.col("id.a").alias("a"), F.col("id.b").alias("b"), "range", "ids")
    long = long.repartition("a", "b").sortWithinPartitions("a", "b", "range").select("a", "b", "ids")
    long = long.mapInArrow(stream, "a long, b long, ends_sha256 string")
    return single.unionByName(long.select(F.struct("a", "b").alias("id"), "ends_sha256"))


def subtree_totals(chains: DataFrame) -> DataFrame:
    """(conv_id, leaves, saved) over a chain and all that hangs on it, from (conv_id, over, leaves, saved):
    after k rounds every chain knows its ancestor 2^k above and the sums of the 2^k levels below."""
    now = staged(chains, "trie-chains")
    while not now.where("over is not null").isEmpty():
        below = now.where("over is not null").groupBy(F.col("over").alias("conv_id")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = now.select(F.col("conv_id").alias("over"), F.col("over").alias("next"))
        now = now.join(below, "conv_id", "left").join(above, "over", "left")
        now = staged(now.select("conv_id", F.col("next").alias("over"), *[(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in ("leaves", "saved")]), "trie-chains")
    return now.drop("over")


def conversation_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), ties by role and then text; repeated rows are turns of their own.
    Null roles and texts are empty. Rows whose conv_id is null belong to no conversation and are left out; an
    empty table has no nodes. Conversations whose rebuilt form is empty are members of the root alone. Further
    columns are ignored. ``%`` keeps the sign of a negative conv_id."""
    turns = ordered_turns(conversations, "trie-turns")
    rebuilt, convs = rebuilt_turns(turns, group, heads)
    blocks = staged(blocks_of(rebuilt), "trie-blocks")
    none = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    last = blocks.groupBy("conv_id").agg(F.max_by("after", "block").alias("id"))
    turnless = convs.where("turns = 0").select("conv_id", none.alias("id"))
    ends = ends_of(last.unionByName(turnless.select("conv_id", "id")))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(none.alias("id"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("up"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = trie_nodes(blocks).unionByName(root)
    nodes = staged(nodes.join(ends, "id", "left"), "trie-nodes")

    heads_of = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "up")).alias("head"), F.max("depth").alias("last"), F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    heads_of = staged(heads_of.select("conv_id", F.col("head.depth").alias("depth"), F.col("head.up").alias("up"), "last", "saved"), "trie-heads")
    low = convs.agg(F.min("conv_id")).first()[0]  # the root's smallest member
    # chains that start with the first turn hang on the root, the others on the node that their prefix names
    top = heads_of.where("depth = 1").withColumn("over", F.lit(low).cast("long"))
    rest = heads_of.where("depth > 1").join(nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("over")), "up")
    hung = staged(top.unionByName(rest.select(*top.columns)).select("conv_id", "over", (F.col("depth") - 1).alias("at")), "trie-hung")
    tails = hung.join(heads_of.select(F.col("conv_id").alias("over"), F.col("last").alias("at")), ["over", "at"], "left_semi").select(F.col("over").alias("conv_id")).distinct()
    chains = heads_of.join(tails.withColumn("forked", F.lit(True)), "conv_id", "left").join(hung.select("conv_id", "over"), "conv_id", "left")
    chains = chains.select("conv_id", "over", F.when(F.col("forked"), 0).otherwise(1).cast("long").alias("leaves"), "saved", "last")
    totals = subtree_totals(chains.select("conv_id", "over", "leaves", "saved"))
    hanging = hung.join(totals, "conv_id").groupBy(F.col("over").alias("conv_id"), F.col("at").alias("depth")).agg(
        F.count(F.lit(1)).alias("hung"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    # along a chain: what a node and the nodes below it own, and what hangs there
    ends_at = chains.select("conv_id", "last", F.col("leaves").alias("leaf"))
    plain = nodes.select("conv_id", "depth", "up", "n_convs", "ends_sha256", F.lit(0).cast("long").alias("hung"), F.lit(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    extra = hanging.select("conv_id", "depth", F.lit(None).cast("struct<a:bigint,b:bigint>").alias("up"), F.lit(None).cast("long").alias("n_convs"), F.lit(None).cast("string").alias("ends_sha256"), "hung", "leaves", "saved")
    tail = ends_at.select("conv_id", F.col("last").alias("depth"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("up"), F.lit(None).cast("long").alias("n_convs"), F.lit(None).cast("string").alias("ends_sha256"),
                          F.lit(0).cast("long").alias("hung"), F.col("leaf").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    segment = F.floor(F.col("depth") / SEGMENT).alias("segment")
    items = plain.unionByName(extra).unionByName(tail).select("*", segment)
    long = items.where("depth >= " + str(SEGMENT)).groupBy("conv_id", "segment").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # sums of later segments, for conversations that have any; a row for the segment before each as well
    after = Window.partitionBy("conv_id").orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = long.select("conv_id", (F.col("segment") - 1).alias("segment"), F.sum("leaves").over(after).alias("later_leaves"), F.sum("saved").over(after).alias("later_saved"))
    down = Window.partitionBy("conv_id", "segment").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = Window.partitionBy("conv_id", "segment").orderBy(F.col("depth").desc()).rangeBetween(Window.currentRow, Window.currentRow)
    summed = items.select("conv_id", "segment", "depth", "up", "n_convs", "ends_sha256", F.sum("hung").over(here).alias("hung"), F.sum("leaves").over(down).alias("leaves"), F.sum("saved").over(down).alias("saved")).where("n_convs is not null")
    summed = summed.join(later, ["conv_id", "segment"], "left").join(heads_of.select("conv_id", F.col("depth").alias("head"), "last"), "conv_id").join(hung.select("conv_id", "over"), "conv_id", "left")
    zero = F.lit(0)
    return summed.select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("head"), F.col("conv_id")).otherwise(F.col("over")).cast("long").alias("parent_conv_id"),
        "n_convs",
        (F.col("hung") + F.when(F.col("depth") < F.col("last"), 1).otherwise(0)).cast("long").alias("n_children"),
        (F.col("leaves") + F.coalesce("later_leaves", zero)).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("later_saved", zero)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
