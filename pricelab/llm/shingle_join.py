"""Jaccard join of documents on word shingles, as a blocked sparse matrix product.

The incidence matrix has a row for each document and a column for each shingle (64-bit hashes). Only columns
that can decide a pair are multiplied: shingles have one global order (frequent ones last), and two sets with
Jaccard t share a shingle among the first n - ceil(t n) + 1 of each. These entries are shipped in packed
arrays to blocks of columns; a block sorts its entries, and documents that meet in a column become a
candidate pair with its overlap count, unless their sizes and positions bound the overlap below
t / (1 + t) (n1 + n2). A parity bitmap of each set (at least two bits a shingle) bounds the overlap again: two
bitmaps differ in no more bits than the sets in shingles. Candidates that pass are verified on the whole texts.

Links are only needed up to connected components, so a column first proposes a star and a chain by size;
its other pairs are proposed again only if they are still in different components. Columns with more than
SMALL_COLUMN documents keep their entries in a table for that, the others their remaining pairs; large
columns go through STAR_ROUNDS more stars around other documents first, and then bound each pair by folded
bitmaps and name it in the first column that its sets share only. Nothing is left out, and a group of
k copies costs about k comparisons, not k^2. Documents with equal sets are one
class from the start.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, components, staged

WORDS = 5
NUM, DEN = 75, 100  # the similarity, as a fraction
BLOCK_ENTRIES = 500_000  # of a block, on average; a worker takes about 60 bytes for each
SMALL_COLUMN = 16
STAR_ROUNDS = 3  # of linear comparisons in large columns before pairs across their components
FREQUENT = 0.001  # of the documents of a batch (twice that of all) that make a shingle frequent
LEAST_BITS = 1024  # of a bitmap
FOLDED = 8  # longs of the folded bitmaps that travel with the entries of large columns
EARLY = 24  # columns of a set that travel with its entries, so that a pair is named in the first shared one
SEGMENT = 4_000_000  # bytes that are hashed together

_RNG = np.random.default_rng(20)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
STEP = _RNG.integers(1, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    if len(kept.get("up", ())) < n:
        inverse = np.uint64(pow(int(BASE), -1, 2**64))
        size = max(n, 1 << 16)
        kept["up"], kept["down"] = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b)]), dtype=np.uint64) for b in (BASE, inverse))
    return kept["up"], kept["down"]


def word_hashes(text: str, kept: dict) -> np.ndarray:
    """A 64-bit hash of each word of the text, A-Z lower-cased: polynomials from prefix sums."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    out = []
    at = 0
    while at < len(raw):
        end = min(at + SEGMENT, len(raw))
        while end < len(raw) and not WHITE[raw[end]]:
            end += 1
        b = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        edge = np.diff(np.concatenate([[True], WHITE[b], [True]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _powers(len(b) + 1, kept)
        total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[b] * up[: len(b)], dtype=np.uint64)])
        out.append(mixed((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(text: str, kept: dict) -> np.ndarray:
    """The document's set, sorted: hashes of its distinct shingles, or of the whole sequence if shorter."""
    w = word_hashes(text, kept)
    if len(w) == 0:
        return w
    if len(w) < WORDS:
        return mixed((w * STEP[: len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(w)) * STEP[WORDS])
    n = len(w) - WORDS + 1
    return np.unique(mixed(sum(w[k : k + n] * STEP[k] for k in range(WORDS))))


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(s: np.ndarray) -> bytes:
    """For each value of the low bits of a shingle, whether the set holds an odd number of them."""
    width = max(LEAST_BITS, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def most_overlap(n1: int, x: bytes, n2: int, y: bytes) -> int:
    """A bound from above on the overlap of two sets, from their sizes and bitmaps."""
    if len(x) < len(y):
        x, y = y, x
    one, two, width = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(x)
    while width > 8 * len(y):
        width //= 2
        one = (one >> width) ^ (one & ((1 << width) - 1))
    return (n1 + n2 - (one ^ two).bit_count()) // 2


def folded(bits: bytes) -> np.ndarray:
    """The bitmap for fewer low bits of the shingles, as FOLDED longs."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, dtype=np.int64).reshape(-1, FOLDED), axis=0)


def needed(n1, n2):
    """Least overlap of two linked sets of these sizes."""
    return -((-NUM * (n1 + n2)) // (NUM + DEN))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * both >= NUM * (len(x) + len(y) - both)


def _survey(batches):
    """Size, class and bitmap of each document's set; and each shingle that is frequent in its batch."""
    kept: dict = {}
    names = ["doc_id", "h", "n", "cid", "bits", "shingle"]
    for batch in batches:
        sets = [shingles(t, kept) for t in batch.column(2).to_pylist()]
        n = len(sets)
        size = pa.array([len(s) for s in sets], pa.int64())
        cid = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
        bits = pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size, cid, bits, pa.nulls(n, pa.int64())], names)
        value, count = np.unique(np.concatenate(sets), return_counts=True)
        often = count >= max(8, FREQUENT * n)
        k = int(often.sum())
        yield pa.RecordBatch.from_arrays([pa.nulls(k, batch.column(0).type), pa.nulls(k, pa.int64()), pa.array(count[often]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(value[often].view(np.int64))], names)


def _index(frequent: np.ndarray, blocks: int):
    """Per batch and block: classes and sizes of its sets; shingle, set and position of each entry."""

    def run(batches):
        kept: dict = {}
        for batch in batches:
            seen: dict[int, int] = {}
            size, parts, owners, places = [], [], [], []
            for text in batch.column(0).to_pylist():
                s = shingles(text, kept)
                if not len(s) or (c := class_of(s)) in seen:
                    continue
                seen[c] = len(seen)
                n = len(s)
                if len(frequent):
                    late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    s = np.concatenate([s[~late], s[late]])
                prefix = n - (-(-NUM * n // DEN)) + 1
                size.append(n)
                parts.append(s[:prefix])
                owners.append(np.full(prefix, seen[c], dtype=np.uint32))
                places.append((np.arange(prefix) * 1000 // n).astype(np.uint8))  # the position from below, in thousandths, at most 250
            if not seen:
                continue
            value, owner, place = np.concatenate(parts), np.concatenate(owners), np.concatenate(places)
            block = ((value >> np.uint64(20)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            ends = np.searchsorted(block[order], np.arange(blocks + 1))
            cids, sizes = np.fromiter(seen, dtype=np.int64), np.array(size, dtype=np.int64)
            for k in range(blocks):
                pick = order[ends[k] : ends[k + 1]]
                if len(pick):
                    used, local = np.unique(owner[pick], return_inverse=True)
                    row = [cids[used], sizes[used].astype(np.uint32), value[pick], local.astype(np.uint16 if len(used) < 65536 else np.uint32), place[pick]]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in row)], ["block", "cids", "sizes", "value", "owner", "place"])

    return run


def _multiply(block: pd.DataFrame, frequent: np.ndarray) -> pd.DataFrame:
    """Of one block of columns: pairs to verify first (kind 1) and later (kind 2), with overlap counts; and
    the entries of large columns (kind 3, or 4 of a frequent shingle: a = class, b = shingle, size, place)."""
    cid, size, value, owner, place = [], [], [], [], []
    base = 0
    for row in block.itertuples(index=False):
        c, v = np.frombuffer(row.cids, dtype=np.int64), np.frombuffer(row.value, dtype=np.uint64)
        cid.append(c)
        size.append(np.frombuffer(row.sizes, dtype=np.uint32))
        value.append(v)
        owner.append(np.frombuffer(row.owner, dtype=np.uint16 if len(c) < 65536 else np.uint32).astype(np.int32) + np.int32(base))
        place.append(np.frombuffer(row.place, dtype=np.uint8))
        base += len(c)
    classes, first, inverse = np.unique(np.concatenate(cid), return_index=True, return_inverse=True)
    size = np.concatenate(size).astype(np.int64)[first]
    value, owner, place = np.concatenate(value), inverse.astype(np.int32)[np.concatenate(owner)], np.concatenate(place)
    # a class comes once in a column: copies in other batches have the same size, value and place
    order = np.lexsort((owner, size.astype(np.uint32)[owner], value))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner, place = value[new], owner[new], place[order[new]].astype(np.int64)
    del order, new
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    width = np.diff(np.concatenate([head, [len(value)]]))
    bound = size[owner] - (place * size[owner]) // 1000  # shingles from this one on, at most

    def pairs(i: np.ndarray, j: np.ndarray, kind: int) -> pd.DataFrame:
        n1, n2 = size[owner[i]], size[owner[j]]
        good = np.minimum(bound[i], bound[j]) >= needed(n1, n2)
        a, b = owner[i[good]].astype(np.int64), owner[j[good]].astype(np.int64)
        key, count = np.unique(np.minimum(a, b) * len(classes) + np.maximum(a, b), return_counts=True)
        a, b = classes[key // len(classes)], classes[key % len(classes)]
        return pd.DataFrame({"kind": kind, "a": np.minimum(a, b), "b": np.maximum(a, b), "n": count, "place": 0})

    out = []
    big = width > 1
    starts, widths = head[big], width[big]
    member = np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths)
    at, hub = np.repeat(starts, widths) + member, np.repeat(starts, widths)
    out.append(pairs(np.concatenate([hub[member > 0], at[member > 1] - 1]), np.concatenate([at[member > 0], at[member > 1]]), 1))
    for w in range(3, SMALL_COLUMN + 1):
        s = starts[widths == w]
        i, j = np.triu_indices(w, 2)
        i, j = i[i > 0], j[i > 0]
        if len(s) and len(i):
            out.append(pairs((s[:, None] + i).ravel(), (s[:, None] + j).ravel(), 2))
    large = np.repeat(widths > SMALL_COLUMN, widths)
    e = at[large]
    out.append(pd.DataFrame({"kind": np.where(np.isin(value[e], frequent), 4, 3), "a": classes[owner[e]], "b": value[e].view(np.int64), "n": size[owner[e]], "place": place[e]}))
    return pd.concat(out, ignore_index=True).astype({"kind": "int32", "a": "int64", "b": "int64", "n": "int64", "place": "int64"})


def _possible(batches):
    """Pairs whose bitmaps leave room for the overlap that a link needs."""
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns[2:]))
        take = pa.array([i for i, (n1, x, n2, y) in enumerate(rows) if most_overlap(n1, x, n2, y) >= needed(n1, n2)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])


def _folded(batches):
    for batch in batches:
        fold = [folded(b) for b in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fold, pa.list_(pa.int64()))], ["cid", "fold"])


def _verified(batches):
    kept: dict = {}
    last: tuple = (None, None)
    for batch in batches:
        a, b, x, y = (c.to_pylist() for c in batch.columns)
        good = []
        for i in range(len(a)):
            if last[0] != a[i]:
                last = (a[i], shingles(x[i], kept))
            if linked(last[1], shingles(y[i], kept)):
                good.append(i)
        take = pa.array(good, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs that are links: bounded by their bitmaps first, so that few texts travel for nothing."""
    for c, other in (("a", "x"), ("b", "y")):
        pairs = pairs.join(texts.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(other)), c)
    pairs = staged(pairs.select("a", "b", "na", "x", "nb", "y").mapInArrow(_possible, "a long, b long"), f"{name}-possible")
    one = texts.select(F.col("cid").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("cid").alias("b"), F.col("text").alias("y"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return staged(both.mapInArrow(_verified, "a long, b long"), name)


def _of(column: str):
    """The component of a class: its root, or itself if it has no link."""
    return F.coalesce(F.col(f"g{column}"), F.col(column))


def _grouped(pairs: DataFrame, group: DataFrame) -> DataFrame:
    for c in "ab":
        pairs = pairs.join(group.select(F.col("node").alias(c), F.col("root").alias(f"g{c}")), c, "left")
    return pairs


def _across(pairs: DataFrame, group: DataFrame) -> DataFrame:
    return _grouped(pairs, group).where(_of("a") != _of("b")).select("a", "b")


def _merged(group: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(node, root) with more links: the components of the roots that they join."""
    top = components(_grouped(links, group).select(_of("a").alias("a"), _of("b").alias("b")), name)
    top = top.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = group.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = top.join(group.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return staged(known.union(alone), name)


def _open_columns(columns: DataFrame, group: DataFrame) -> DataFrame:
    """Entries of large columns that hold more than one component; ``left``: shingles from the entry on, at most."""
    group = group.select(F.col("node").alias("cid"), F.col("root").alias("g"))
    of = columns.join(group, "cid", "left").select("shingle", "late", "cid", "n", F.expr("n - (place * n) div 1000").alias("left"), F.coalesce("g", "cid").alias("g"))
    several = of.groupBy("shingle").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("shingle")
    return of.join(several, "shingle")


def _across_columns(entries: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of different components in the large columns, as far as sizes, positions and bitmaps allow a link.

    A linked pair that no small column holds has its first shared shingle in one of these columns; there the
    position bound holds, and there the pair is named. Where the EARLY columns of two sets share none, it is
    named in every column that passes."""
    band = F.floor(F.log("n") / float(np.log(DEN / NUM) * 1.001)).cast("int")  # linked sets are in one band or neighbours
    place = F.struct("late", F.col("shingle").bitwiseXOR(F.lit(-(2**63))).alias("unsigned"), "shingle")
    early = entries.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list(place)), 1, EARLY)["shingle"].alias("early"))
    fold = texts.join(entries.select("cid").distinct(), "cid", "left_semi").select("cid", "bits").mapInArrow(_folded, "cid long, fold array<long>")
    of = staged(entries.join(early.join(fold, "cid"), "cid").withColumn("band", band), "shingle-open")
    names = {"cid": "", "n": "n", "left": "l", "g": "g", "early": "e", "fold": "f"}
    x, y = (of.select("shingle", "band", *(F.col(c).alias(s + p) for c, s in names.items())) for p in "ab")
    x = x.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    differ = " + ".join(f"bit_count(fa[{i}] ^ fb[{i}])" for i in range(FOLDED))
    bounds = [
        F.expr("(na < nb OR na = nb AND a < b) AND ga <> gb"),
        F.expr(f"least(la, lb) * {NUM + DEN} >= {NUM} * (na + nb)"),
        F.expr(f"((na + nb - ({differ})) div 2) * {NUM + DEN} >= {NUM} * (na + nb)"),
        F.expr("coalesce(get(array_intersect(ea, eb), 0), x.shingle) = x.shingle"),
    ]
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.band") == F.col("y.band"))
    for b in bounds:
        same = same & b
    return x.alias("x").join(y.alias("y"), same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _members(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, h, n, cid) and, for each class, component_id and the first row (none, low, h) of its component."""
    docs = documents.select("doc_id", F.xxhash64(body()).alias("h"), body().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    survey = staged(docs.mapInArrow(_survey, f"doc_id {kind}, h long, n long, cid long, bits binary, shingle long"), "shingle-survey")
    rows = survey.where("shingle is null")
    total = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n")).first()
    # a shingle in 2 FREQUENT of all documents is frequent in some batch; their number is at most the mean set size / FREQUENT
    often = survey.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT * total["docs"])
    frequent = np.sort(np.array([r["shingle"] for r in often.select("shingle").collect()], dtype=np.int64).view(np.uint64))
    classes = staged(rows.where("n > 0").groupBy("cid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n", "bits")).alias("rep")), "shingle-classes")

    blocks = int((total["n"] or 0) * (DEN - NUM) // DEN // BLOCK_ENTRIES + 1)
    packed = docs.select("text").mapInArrow(_index(frequent, blocks), "block int, cids binary, sizes binary, value binary, owner binary, place binary")
    product = packed.groupBy("block").applyInPandas(lambda block: _multiply(block, frequent), "kind int, a long, b long, n long, place long")
    product = staged(product, "shingle-product")
    counted = staged(product.where("kind < 3").groupBy("a", "b").agg(F.min("kind").alias("kind"), F.sum("n").alias("overlap")), "shingle-pairs")
    columns = product.where("kind >= 3").select(F.col("b").alias("shingle"), (F.col("kind") == 4).alias("late"), F.col("a").alias("cid"), "n", "place")

    named = counted.select(F.col("a").alias("cid")).union(counted.select("b")).union(columns.select("cid")).distinct()
    reps = named.join(classes, "cid").select("cid", F.col("rep.doc_id").alias("__id"), F.col("rep.h").alias("__h"), F.col("rep.n").alias("__n"), F.col("rep.bits").alias("__bits"))
    found = docs.join(reps, (docs.h == F.col("__h")) & docs.doc_id.eqNullSafe(F.col("__id")))
    texts = staged(found.select("cid", F.col("__n").alias("n"), F.col("__bits").alias("bits"), "text").dropDuplicates(["cid"]), "shingle-texts")

    links = verified(counted.where("kind = 1"), texts, "shingle-links")
    group = components(links, "shingles-first")
    columns = staged(columns, "shingle-columns")
    for turn in range(STAR_ROUNDS):
        open_ = _open_columns(columns, group)
        if open_.isEmpty():
            break
        hub = open_.groupBy("shingle").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "cid").alias("o"), "cid", "n", "left", "g")).alias("hub"))
        star = open_.join(hub, "shingle").where((F.col("g") != F.col("hub.g")) & F.expr(f"least(left, hub.left) * {NUM + DEN} >= {NUM} * (n + hub.n)"))
        star = star.select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()
        group = _merged(group, verified(star, texts, "shingle-links"), f"shingles-star-{turn}")

    # what is still open: remaining pairs of small columns, and pairs across components of large ones
    later = _across(counted.where("kind = 2").select("a", "b"), group)
    across = _across_columns(_open_columns(columns, group), texts)
    rest = staged(later.union(across).distinct(), "shingle-rest")
    if not rest.isEmpty():
        group = _merged(group, verified(rest, texts, "shingle-links"), "shingles-rest")

    member = classes.join(group.withColumnRenamed("node", "cid"), "cid", "left")
    member = staged(member.select("cid", F.coalesce("root", "cid").alias("root"), F.col("rep.none").alias("none"), F.col("rep.doc_id").alias("low"), F.col("rep.h").alias("h")), "shingle-members")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"), F.min(F.struct("none", "low", "h")).alias("first"))
    return rows, staged(member.select("cid", "root").join(lowest, "root").select("cid", "component_id", "first"), "shingle-result")


def near_groups(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Null, empty and white texts have no shingles and link with nothing (component_id is their doc_id).
    Repeated rows link like other equal texts. A row with a null doc_id links others but names no
    component. An empty table gives an empty result; other columns are not read."""
    rows, member = _members(documents)
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    some = rows.where("n > 0").join(member, "cid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(none)


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each group of ``documents``, all columns, and every row without shingles.

    The row with the smallest doc_id stays, one with a null doc_id only where its group has no other; of
    different texts under that doc_id (or null), the one with the smallest hash."""
    rows, member = _members(documents)
    linked = rows.where("n > 0").groupBy("doc_id", "h", "cid").agg(F.count(F.lit(1)).alias("times")).join(member, "cid")
    stays = F.col("doc_id").eqNullSafe(F.col("first.low")) & (F.col("h") == F.col("first.h"))
    key = [F.col("doc_id").alias("id"), F.col("h").alias("key")]
    linked = staged(linked.where(~stays | (F.col("times") > 1)).select(*key, stays.alias("stays")), "shingle-dropped")
    docs = documents.select("doc_id", F.xxhash64(body()).alias("h"), F.struct("*").alias("row"))
    same = (F.col("h") == F.col("key")) & docs["doc_id"].eqNullSafe(F.col("id"))
    left = docs.join(linked, same, "left_anti")
    again = linked.where("stays")
    if not again.isEmpty():
        left = left.unionByName(docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "h"]))
    return left.select("row.*")
