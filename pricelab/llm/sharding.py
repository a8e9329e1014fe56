"""Shards balanced in bytes, tokens and rows at once, by vector bin packing of groups of equal texts.

Every item (a group, or a piece of one too large for a shard) is a vector (bytes, tokens, rows), each as a
share of the whole; it goes to the shard where the dot product of the vector and the residual capacity is
highest, largest items first. Two levels keep this off a single machine:

* large items (over 1 / (64 x shards) of any total: at most 3 x 64 x shards of them, whatever the size of
  the table) are placed first;
* all others are dealt by a hash into cells; each cell packs its groups into ``shards`` bundles inside one
  Spark task, bundles of ``WIDER`` cells are packed again while there are more than MAX_CELLS cells, and the
  bundles (at most MAX_CELLS x shards) are placed like items.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, body, bucket_of, ranked, staged

LARGE = 64  # items over 1 / (LARGE x shards) of a total are placed one by one
SPLIT = 2  # groups over 1 / (SPLIT x shards) of a total are split into pieces of 1 / (8 x shards)
CELL_GROUPS = 512  # rows of the table per cell
MAX_CELLS = 4096  # cells whose bundles the driver places
WIDER = 64  # cells whose bundles one task packs again where there are more
DIMS = ["size", "tokens", "rows"]


def place(vectors: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each item: largest first, to the highest dot product with the residual capacity, which is
    updated in place. ``vectors`` and ``residual`` are shares of the totals; ties go to the lowest shard."""
    out = np.zeros(len(vectors), dtype=np.int32)
    for i in np.argsort(-vectors.max(axis=1), kind="stable"):
        best = int(np.argmax(residual @ vectors[i]))
        out[i] = best
        residual[best] -= vectors[i]
    return out


def _bundles(shards: int):
    def pack(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("key", kind="stable")
        v = cell[DIMS].to_numpy(dtype=float)
        v /= np.maximum(v.sum(axis=0), 1)
        cell["bundle"] = place(v, np.full((shards, len(DIMS)), 1 / shards))
        return cell

    return pack


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row; the law is ``bytes``.

    Rows with equal texts share a shard unless their group exceeds half a shard, when it is split evenly.
    Null and empty texts have size 1 and form one group; null doc_ids and repeated rows are placed like
    others; an empty table gives an empty result. ``slot`` numbers the rows of a shard from 0."""
    spark = documents.sparkSession
    text = body()
    base = staged(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
            F.monotonically_increasing_id().alias("row"),  # fixed once it is written
        ),
        "shard-rows",
    )
    total = base.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
    whole = np.array([max(total[d] or 0, 1) for d in DIMS], dtype=float)
    groups = staged(base.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens")), "shard-groups")
    share = F.greatest(*[F.col(d) / float(w) for d, w in zip(DIMS, whole)])
    is_large = share > 1 / (LARGE * shards)

    # large groups: at most 3 x LARGE x shards rows reach the driver
    large = groups.where(is_large).orderBy("key").toPandas()
    large["pieces"] = 1
    if len(large):
        biggest = (large[DIMS].to_numpy(dtype=float) / whole).max(axis=1)
        cut = np.ceil(biggest * shards * 8).astype(int)
        large["pieces"] = np.where(biggest > 1 / (SPLIT * shards), np.minimum(cut, large["rows"].to_numpy()), 1)
    pieces = spark.createDataFrame([(bytearray(k), int(p)) for k, p in zip(large["key"], large["pieces"])], "key binary, pieces int")
    piece = F.pmod(F.xxhash64(F.lit(9), F.col("row")), F.col("pieces")).cast("int")  # rows of one id or none are cut as well
    heavy = base.join(F.broadcast(pieces), "key").withColumn("piece", piece)
    items = heavy.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens"))
    items = items.orderBy("key", "piece").toPandas()
    residual = np.full((shards, len(DIMS)), 1 / shards)
    put = place(items[DIMS].to_numpy(dtype=float).reshape(-1, len(DIMS)) / whole, residual)
    placed = spark.createDataFrame([(bytearray(k), int(p), int(s)) for k, p, s in zip(items["key"], items["piece"], put)], "key binary, piece int, shard int")
    columns = ["doc_id", "size", "text_crc32", "key", "row", "shard"]
    heavy = heavy.join(F.broadcast(placed), ["key", "piece"]).select(*columns)

    # all others: bundles of one cell each, then the bundles
    cells = int(max(total["rows"] // CELL_GROUPS, 1))
    light = groups.where(~is_large).withColumn("cell", bucket_of(cells, "key").cast("long"))
    kinds = "rows long, size long, tokens long, cell long, bundle int"
    light = staged(light.groupBy("cell").applyInPandas(_bundles(shards), f"key binary, {kinds}"), "shard-bundles")
    dims = [F.sum(d).alias(d) for d in DIMS]
    found = light.select("key", "cell", "bundle")
    bundles = light.groupBy("cell", "bundle").agg(*dims)
    while cells > MAX_CELLS:  # bundles of many cells are packed again, in tasks, before any come to the driver
        cells = -(-cells // WIDER)
        packed = bundles.withColumnsRenamed({"cell": "from_cell", "bundle": "from_bundle"}).withColumn("cell", F.col("from_cell") % cells)
        packed = packed.withColumn("key", F.concat_ws(":", "from_cell", "from_bundle"))
        packed = packed.select("key", *DIMS, "cell", "from_cell", "from_bundle").groupBy("cell").applyInPandas(
            _bundles(shards), "key string, size long, tokens long, rows long, cell long, from_cell long, from_bundle int, bundle int")
        packed = staged(packed, "shard-bundles")
        up = packed.select(F.col("from_cell").alias("cell"), F.col("from_bundle").alias("bundle"), F.col("cell").alias("to_cell"), F.col("bundle").alias("to_bundle"))
        found = found.join(up, ["cell", "bundle"]).select("key", F.col("to_cell").alias("cell"), F.col("to_bundle").alias("bundle"))
        bundles = packed.groupBy("cell", "bundle").agg(*dims)
    bundles = bundles.orderBy("cell", "bundle").toPandas()
    put = place(bundles[DIMS].to_numpy(dtype=float).reshape(-1, len(DIMS)) / whole, residual)
    rows = [(int(c), int(b), int(s)) for c, b, s in zip(bundles["cell"], bundles["bundle"], put)]
    where = spark.createDataFrame(rows, "cell long, bundle int, shard int")
    found = found.join(F.broadcast(where), ["cell", "bundle"]).select("key", "shard")
    out = staged(heavy.unionByName(base.join(found, "key").select(*columns)), "shard-placed")

    buckets = int(min(total["rows"] // (256 * shards) + 1, 65536))
    out = ranked(out, "shard", ["row"], ["doc_id", "key", "row"], buckets, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
