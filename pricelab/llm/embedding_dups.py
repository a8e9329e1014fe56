"""Near duplicates among embeddings by Euclidean p-stable hashing.

Vectors are scaled to length one; each of TABLES tables rounds HASHES random projections, shifted and
divided by WIDTH, to integers, and vectors with the same integers share a bucket. At cosine 0.98 (distance
0.2) one rounding agrees with probability 0.84, so a pair shares a table with probability 1 - (1 - 0.84^6)^16
= 0.999. All pairs of a bucket are compared exactly in double precision.

Equal vectors are one class from the start. A bucket's rows are dealt into chunks of TILE rows, and pairs of
chunks (tiles) are compared as matrix products, so no task holds a large bucket. A tile returns one number
per vector (links that no earlier table found) and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, components, staged

TABLES, HASHES, WIDTH = 16, 6, 1.0
TILE = 512
GROUP_ROWS = 2048  # rows of tiles that one Python call compares
THRESHOLD = 0.98


def table_keys(unit: np.ndarray, seed: int = 3) -> np.ndarray:
    """(vectors, TABLES) bucket numbers of unit vectors; the projections depend on the dimension only."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    direction = rng.standard_normal((unit.shape[1], TABLES * HASHES))
    shift = rng.uniform(0, WIDTH, TABLES * HASHES)
    cell = np.floor((unit @ direction + shift) / WIDTH).astype(np.int64).reshape(len(unit), TABLES, HASHES)
    mixer = rng.integers(1, 2**62, HASHES, dtype=np.int64) * 2 + 1
    return (cell * mixer).sum(axis=2)


def _keys(batches):
    for batch in batches:
        vectors = batch.column(1).to_pylist()
        keys: list[bytes | None] = [None] * len(vectors)
        raw: list[bytes | None] = [None] * len(vectors)
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_size.setdefault(len(v), []).append(i)
        for where in by_size.values():
            x = np.array([vectors[i] for i in where], dtype=np.float64)
            unit = x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)
            for i, k, u in zip(where, table_keys(unit), unit):
                keys[i], raw[i] = k.tobytes(), u.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array(keys, pa.binary())], ["cid", "unit", "keys"])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the component of each of n nodes under the links a-b."""
    low = np.arange(n)
    while True:
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == before).all():
            return low


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for (table, _, i, j), tile in group.groupby(["t", "bucket", "i", "j"], sort=True):
        tile = tile.sort_values(["chunk", "cid"])
        unit = np.stack([np.frombuffer(u) for u in tile["unit"]])
        left = int((tile["chunk"] == i).sum())
        rows, cols = (slice(0, left), slice(left, None)) if i < j else (slice(None), slice(None))
        cosine = unit[rows] @ unit[cols].T
        if i == j:
            cosine[np.tril_indices(len(unit))] = -1
        a, b = np.nonzero(cosine >= THRESHOLD)
        if not len(a):
            continue
        b = b + (left if i < j else 0)
        keys = np.stack([np.frombuffer(k, dtype=np.int64) for k in tile["keys"]])
        known = (keys[a, :table] == keys[b, :table]).any(axis=1) if table else np.zeros(len(a), dtype=bool)
        cid, copies, n = tile["cid"].to_numpy(), tile["copies"].to_numpy(), len(tile)
        links = np.bincount(a[~known], copies[b[~known]], n) + np.bincount(b[~known], copies[a[~known]], n)
        root = _forest(a, b, n)
        seen = np.flatnonzero((links > 0) | (root != np.arange(n)))
        out.append((cid[seen], cid[root[seen]], links[seen].astype(np.int64)))
    if not out:
        return pd.DataFrame({"cid": [], "root": [], "links": []}).astype("int64")
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("cid", "root", "links"), zip(*out))})


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, empty, zero, or hold null or non-finite numbers, and rows without label, link
    with nothing. Vectors of different length never link. Repeated rows are rows of their own; a null
    vec_id counts as a link of others but names no component."""
    good = "label is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    rows = embeddings.select("vec_id", "label", "embedding").withColumn("valid", F.coalesce(F.expr(good), F.lit(False)))
    classes = rows.where("valid").groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    hashed = staged(classes.select("cid", "embedding").mapInArrow(_keys, "cid long, unit binary, keys binary"), "vector-keys")
    info = classes.select("cid", "label", "copies", F.size("embedding").alias("dim"))
    hashed = staged(hashed.join(info, "cid"), "vector-hashed")
    key = F.expr("substring(keys, t * 8 + 1, 8)")
    spots = hashed.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))))
    spots = spots.withColumn("bucket", F.xxhash64("label", "dim", "t", key))
    sizes = staged(spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "vector-buckets")
    work = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / TILE))).first()[0] or 0
    groups = int(work // GROUP_ROWS + 1)

    tiles = spots.join(sizes, "bucket").withColumn("chunks", F.ceil(F.col("n") / TILE).cast("int"))
    tiles = tiles.withColumn("chunk", F.pmod(F.xxhash64(F.lit(4), "cid"), F.col("chunks")).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    tiles = tiles.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
    tiles = tiles.withColumn("g", bucket_of(groups, "bucket", "i", "j", seed=6))
    tiles = tiles.select("g", "t", "bucket", "i", "j", "chunk", "cid", "copies", "unit", "keys")
    found = staged(tiles.groupBy("g").applyInPandas(_compare, "cid long, root long, links long"), "vector-links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "vectors")
    member = classes.join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    member = staged(member.select("label", "embedding", "low", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root")), "vector-members")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    member = staged(member.join(lowest, "root").select("label", "embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-result")

    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("valid").join(member, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
