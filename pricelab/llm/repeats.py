"""Repeated passages by sharded suffix arrays: bytes covered by a string of SPAN bytes that also starts in
a document with a smaller doc_id.

Every string of SPAN bytes has a mark that only its content decides: the smallest hash of its GRAM-byte
substrings. Runs of positions with one mark are segments (the run's strings, at most 64). Strings can only
be equal under equal marks, so

1. marks are shipped to blocks in packed arrays (four bytes and an owner each); marks that at least two
   documents hold come back to their documents;
2. the segments of those marks are shipped by mark to shards; each shard's distinct segments, without the
   ends whose strings have a hash of their own, are one text, whose suffix array is built by induced sorting; neighbours in it with a common prefix of SPAN bytes are
   equal strings, and each string's smallest doc_id decides every occurrence;
3. the decisions come back as one bit a position, and the documents drop the covered bytes.

Before either shuffle a batch keeps one copy of a mark or segment, that of its smallest doc_id, and settles
the others itself, so a passage in a third of all documents is one entry a batch. Answers, and what batches
settled, are dealt to parts by a hash of doc_id and text, so copies of one text are spread over all parts. A mark with
more than HOT segments (the edges of a passage, a run of spaces) is hot: its segments are cut into single
strings, which are dealt to shards by their own bytes.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, staged
from .suffix_array import same_prefix, suffix_array

SPAN, GRAM, RUN = 50, 16, 64
PIECE = 1 << 20  # positions of a text that are hashed together
BLOCK_MARKS = 6_000_000
SHARD_SEGMENTS = 40_000
HOT = SHARD_SEGMENTS // 2  # segments of one mark from which its strings are dealt one by one
GROUP_DOCUMENTS = 4096  # documents whose answers come back together
LAST = np.int64(2**63 - 1)  # stands for a null doc_id: larger than all

_RNG = np.random.default_rng(50)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
STEP = _RNG.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def segments(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mark, first position, number of positions) of the runs of a text's strings of SPAN bytes."""
    parts = []
    for at in range(0, len(raw) - SPAN + 1, PIECE):
        b = np.frombuffer(raw, dtype=np.uint8, count=min(PIECE + SPAN - 1, len(raw) - at), offset=at)
        h, width = BYTE[b], 1
        while width < GRAM:
            h = h[:-width] * STEP[width.bit_length()] + h[width:]
            width *= 2
        h ^= h >> np.uint64(29)
        h *= STEP[6]
        h ^= h >> np.uint64(32)
        mark = _window_min(h, SPAN - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
        count = np.diff(np.append(first, len(mark)))
        if (count > RUN).any():
            times = -(-count // RUN)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            first, end = np.repeat(first, times) + nth * RUN, np.repeat(first + count, times)
            count = np.minimum(end - first, RUN)
        parts.append((mark[first], first + at, count))
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _low(mark: np.ndarray) -> np.ndarray:
    return (mark & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _ids(column: pa.Array) -> np.ndarray:
    return np.array([LAST if i is None else i for i in column.to_pylist()], dtype=np.int64)


def _split(group: np.ndarray, columns: list[np.ndarray], ids: np.ndarray, hs: np.ndarray, owner: np.ndarray):
    """For each group: the ids and hashes of the documents in it, each entry's document, its columns."""
    order = np.argsort(group, kind="stable")
    cut = np.flatnonzero(np.diff(group[order])) + 1
    for pick in np.split(order, cut) if len(order) else []:
        used, local = np.unique(owner[pick], return_inverse=True)
        yield int(group[pick[0]]), [ids[used], hs[used], local.astype(np.uint32), *(c[pick] for c in columns)], pick


def _parts(ids: np.ndarray, hs: np.ndarray, groups: int) -> np.ndarray:
    """The group of documents that each document's answers come back to."""
    x = ids.view(np.uint64) * STEP[7] ^ hs.view(np.uint64)
    x ^= x >> np.uint64(29)
    return ((x * STEP[6] >> np.uint64(16)) % np.uint64(groups)).astype(np.int64)


def _in_order(ids: np.ndarray, hs: np.ndarray) -> list[int]:
    """The rows of a batch by doc_id; of rows with one doc_id and one text only the first."""
    once = np.unique(np.stack([ids, hs]), axis=1, return_index=True)[1]
    return np.sort(once)[np.argsort(ids[np.sort(once)], kind="stable")].tolist()


def _cut(s: bytes):
    """(position, count, bytes) of the pieces of a segment: each the run of positions with one equal string."""
    at, end = 0, len(s) - SPAN + 1
    while at < end:
        n = 1
        if s.count(s[at], at, at + SPAN) == SPAN:  # one byte over and over: the strings after it are the same
            while at + n < end and s[at + SPAN + n - 1] == s[at]:
                n += 1
        yield at, n, s[at : at + n + SPAN - 1]
        at += n


def _frequent(segs: list, marks: np.ndarray) -> np.ndarray:
    """For each of these (sorted) marks: positions of the batch's segments that differ by mark or neighbours."""
    around, total = [], np.zeros(len(marks), dtype=np.int64)
    for mark, _, count in segs:
        at = np.searchsorted(marks, mark)
        near = np.flatnonzero(marks[np.minimum(at, len(marks) - 1)] == mark)
        wide = np.concatenate([[np.uint64(0)], mark, [np.uint64(1)]])
        around.append(np.stack([at[near].astype(np.uint64), wide[near] * STEP[5] + wide[near + 2], count[near].astype(np.uint64)]))
    at, _, count = np.unique(np.concatenate(around, axis=1), axis=1)
    np.add.at(total, at.astype(np.int64), count.astype(np.int64))
    return total


def _marks(blocks: int, groups: int, total: int):
    """Besides marks: those with at least their share of HOT / 2 segments in a batch, as a share of ``total``
    bytes, with their segments and positions. A mark with HOT segments has more than half of them reported."""

    def run(batches):
        for batch in batches:
            ids, hs = _ids(batch.column(0)), batch.column(1).to_numpy()
            part = _parts(ids, hs, groups)
            texts = batch.column(2)
            mark, owner, times, segs, size = [], [], [], [], 0
            for i in _in_order(ids, hs):
                raw = texts[i].as_py().encode("utf-8", "surrogatepass")
                size += len(raw)
                segs.append(segments(raw))
                m, n = np.unique(segs[-1][0], return_counts=True)
                mark.append(m)
                times.append(n)
                owner.append(np.full(len(m), i))
            mark, owner, times = np.concatenate(mark), np.concatenate(owner), np.concatenate(times)
            by = np.argsort(mark, kind="stable")  # inside a mark, documents stay in the order of their ids
            mark, owner, times = mark[by], owner[by], times[by]
            head = np.concatenate([[True], mark[1:] != mark[:-1]])[: len(mark)]
            at = np.flatnonzero(head)
            width = np.diff(np.append(at, len(mark)))
            times = np.add.reduceat(times, at) if len(at) else times
            often = np.flatnonzero(times * total >= HOT / 2 * size)
            if len(often):
                names, held = mark[at[often]], _frequent(segs, mark[at[often]])
                block = ((names >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
                for k in np.unique(block).tolist():
                    row = [x[block == k].tobytes() for x in (names, times[often], held)]
                    yield pa.RecordBatch.from_arrays([pa.array([-1 - groups - k], pa.int32()), *(pa.array([x], pa.binary()) for x in (*row, b""))], ["block", "ids", "hs", "owner", "low"])
            lowest, highest = ids[owner[at]], ids[owner[at + width - 1]] if len(at) else ids[:0]
            first = ids[owner] == np.repeat(lowest, width)
            settled = np.repeat(lowest != highest, width)
            block = ((mark >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
            for chosen, group in ((first, block), (settled, -1 - part[owner])):
                for k, row, _ in _split(group[chosen], [_low(mark[chosen])], ids, hs, owner[chosen]):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in row)], ["block", "ids", "hs", "owner", "low"])

    return run


def _joined(rows: pd.DataFrame, kinds: dict) -> tuple[np.ndarray, ...]:
    """The packed rows of a group as whole arrays; owners count through all rows."""
    base, owners = 0, []
    for ids, owner in zip(rows["ids"], rows["owner"]):
        owners.append(np.frombuffer(owner, dtype=np.uint32).astype(np.int64) + base)
        base += len(ids) // 8
    each = [np.frombuffer(b"".join(rows[c]), dtype=t) for c, t in kinds.items()]
    ids, hs = (np.frombuffer(b"".join(rows[c]), dtype=np.int64) for c in ("ids", "hs"))
    return ids, hs, np.concatenate(owners), *each


def _returned(ids, hs, owner, columns: dict[str, np.ndarray], groups: int) -> pd.DataFrame:
    """Packed rows for groups of documents."""
    group = _parts(ids, hs, groups)[owner]
    names = ["part", "ids", "hs", "owner", *columns]
    rows = [[k, *(x.tobytes() for x in row)] for k, row, _ in _split(group, list(columns.values()), ids, hs, owner)]
    return pd.DataFrame(rows, columns=names).astype({"part": "int64"})


def _per_document(kinds: dict):
    """One row per document of a group: its entries of every block or shard. Of hot marks (negative parts),
    one row a mark: it, its positions and null entries."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["part"].iloc[0] < 0:
            mark, held = (np.frombuffer(b"".join(rows[c]), dtype=np.int64) for c in ("ids", "hs"))
            return pd.DataFrame({"doc_id": mark.astype("int64"), "h": held.astype("int64")} | {n: pd.Series([None] * len(mark), dtype=object) for n in kinds})
        ids, hs, owner, *columns = _joined(rows, kinds)
        key, doc = np.unique(np.stack([hs, ids]), axis=1, return_inverse=True)
        doc = doc.ravel()[owner]
        order = np.argsort(doc, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []
        at = [int(doc[p[0]]) for p in parts]
        out = {"doc_id": pd.array([None if i == LAST else i for i in key[1, at].tolist()], dtype="Int64"), "h": key[0, at]}
        return pd.DataFrame(out | {n: pd.Series([c[p].tobytes() for p in parts], dtype=object) for n, c in zip(kinds, columns)})

    return run


def _shared(groups: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Marks of one block that documents of different ids hold; of reports, the hot marks."""
        if rows["block"].iloc[0] < -groups:
            mark, times, held = (np.frombuffer(b"".join(rows[c]), dtype=t) for c, t in (("ids", np.uint64), ("hs", np.int64), ("owner", np.int64)))
            mark, at = np.unique(mark, return_inverse=True)
            times, held = (np.bincount(at, x, len(mark)).astype(np.int64) for x in (times, held))
            hot = times >= HOT / 2
            row = [int(rows["block"].iloc[0]), *(x[hot].tobytes() for x in (mark, held)), b"", b""]
            return pd.DataFrame([row], columns=["part", "ids", "hs", "owner", "low"]).astype({"part": "int64"})
        ids, hs, owner, low = _joined(rows, {"low": np.uint32})
        if rows["block"].iloc[0] >= 0:
            order = np.lexsort((ids[owner], low))
            owner, low = owner[order], low[order]
            at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            width = np.diff(np.append(at, len(low)))
            keep = np.repeat(ids[owner[at]] != ids[owner[at + width - 1]], width)
            owner, low = owner[keep], low[keep]
        return _returned(ids, hs, owner, {"low": low}, groups)

    return run


def _segments(shards: int, groups: int, hot: np.ndarray):
    def run(batches):
        for batch in batches:
            ids, hs = _ids(batch.column(0)), batch.column(1).to_numpy()
            part = _parts(ids, hs, groups)
            seen: dict[bytes, int] = {}
            shard, owner, first, count, text = [], [], [], [], []
            local: list[tuple[int, int, int]] = []
            for i in _in_order(ids, hs):
                raw = batch.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                wanted = np.frombuffer(batch.column(3)[i].as_py(), dtype=np.uint32)
                mark, at, n = segments(raw)
                keep = np.isin(_low(mark), wanted)
                to = ((mark[keep] >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
                to[np.isin(mark[keep], hot)] = -1
                for k, a, c in zip(to.tolist(), at[keep].tolist(), n[keep].tolist()):
                    s = raw[a : a + c + SPAN - 1]
                    if seen.setdefault(s, ids[i]) < ids[i]:
                        local.append((i, a, c))
                    elif k < 0:
                        for p, c, t in _cut(s):
                            if seen.setdefault(t, ids[i]) < ids[i]:
                                local.append((i, a + p, c))
                            else:
                                shard.append(zlib.crc32(t[:SPAN]) % shards)
                                owner.append(i)
                                first.append(a + p)
                                count.append(c)
                                text.append(t)
                    else:
                        shard.append(k)
                        owner.append(i)
                        first.append(a)
                        count.append(c)
                        text.append(s)
            names = ["shard", "ids", "hs", "owner", "first", "count", "mask", "text"]
            owner, first, count = (np.array(x, dtype=np.int64) for x in (owner, first, count))
            for k, row, pick in _split(np.array(shard, dtype=np.int64), [first.astype(np.uint32), count.astype(np.uint8)], ids, hs, owner):
                row = [*(x.tobytes() for x in row), b"", b"".join(text[p] for p in pick.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], names)
            if local:
                owner, first, count = np.array(local, dtype=np.int64).T
                mask = np.uint64(2**64 - 1) >> (64 - count).astype(np.uint64)
                for k, row, _ in _split(-1 - part[owner], [first.astype(np.uint32), count.astype(np.uint8), mask], ids, hs, owner):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in row), pa.array([b""], pa.binary())], names)

    return run


def _string_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the SPAN bytes from each position that has as many."""
    h, width, kept = BYTE[raw], 1, {}
    while width < SPAN:
        if width & SPAN:
            kept[width] = h
        if width * 2 > SPAN:
            break
        h = h[:-width] * STEP[width.bit_length()] + h[width:]
        width *= 2
    at, out = 0, np.zeros(len(raw) - SPAN + 1, dtype=np.uint64)
    for width in sorted(kept, reverse=True):
        out = out * STEP[0] + kept[width][at : at + len(out)]
        at += width
    return out ^ out >> np.uint64(31)


def _seen_again(raw: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts, first, last offset) of the strings whose hash another string of the shard has. Equal strings
    have equal hashes, so what is left out stands once."""
    own = np.repeat(np.arange(len(start)), count)
    offset = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    h = _string_hashes(raw)[start[own] + offset]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(len(h), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    own, offset = own[again], offset[again]
    head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(own)])
    return own[head], offset[head], offset[np.append(head[1:], len(own)) - 1] if len(own) else head


def smallest_ids(texts: list[bytes], low: np.ndarray) -> np.ndarray:
    """(texts, RUN): for each string of SPAN bytes the smallest ``low`` of the texts that hold it."""
    size = np.array([len(t) for t in texts])
    out = np.where(np.arange(RUN) <= (size - SPAN)[:, None], low[:, None], LAST)
    whole = np.frombuffer(b"\0".join(texts), dtype=np.uint8)
    which, first, last = _seen_again(whole, np.cumsum(size + 1) - size - 1, size - SPAN + 1)
    if not len(which):
        return out
    texts = [texts[w][f : e + SPAN] for w, f, e in zip(which.tolist(), first.tolist(), last.tolist())]
    size, low = last - first + SPAN, low[which]
    raw = np.frombuffer(b"\0".join(texts) + b"\0" * 8, dtype=np.uint8)
    start = np.cumsum(size + 1) - size - 1
    symbol = raw[: int(size.sum()) + len(texts)].astype(np.int16) + 1
    symbol[start + size] = 0  # between segments
    own = np.repeat(np.arange(len(texts)), size + 1)
    offset = np.arange(len(symbol)) - start[own]
    order = suffix_array(symbol, SPAN)
    order = order[offset[order] + SPAN <= size[own[order]]]  # strings of whole length
    common = np.zeros(len(symbol), dtype=bool)  # in text order: shares SPAN bytes with the one before it in the array
    common[order[1:]] = same_prefix(raw, order[1:], order[:-1], SPAN)
    head = np.flatnonzero(~common[order])
    least = np.minimum.reduceat(low[own[order]], head)
    out[which[own[order]], first[own[order]] + offset[order]] = np.repeat(least, np.diff(np.append(head, len(order))))
    return out


def _decide(groups: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Which positions of each segment of one shard start a string that an earlier document holds."""
        ids, hs, owner, first, count = _joined(rows, {"first": np.uint32, "count": np.uint8})
        if rows["shard"].iloc[0] < 0:
            mask = np.frombuffer(b"".join(rows["mask"]), dtype=np.uint64)
            return _returned(ids, hs, owner, {"first": first, "mask": mask}, groups)
        whole = b"".join(rows["text"])
        end = np.cumsum(count.astype(np.int64) + SPAN - 1)
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(whole[e - c - SPAN + 1 : e], len(number)) for e, c in zip(end.tolist(), count.tolist())])
        low = np.full(len(number), LAST)
        np.minimum.at(low, which, ids[owner])
        least = smallest_ids(list(number), low)
        bits = least[which] < ids[owner][:, None]
        mask = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
        hit = mask != 0
        return _returned(ids, hs, owner[hit], {"first": first[hit], "mask": mask[hit]}, groups)

    return run


def _cleaned(batches):
    for batch in batches:
        out = []
        for text, first, mask in zip(batch.column(2), batch.column(3), batch.column(4)):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            at = np.frombuffer(first.as_py(), dtype=np.uint32).astype(np.int64)
            bits = np.unpackbits(np.frombuffer(mask.as_py(), dtype=np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            seg, offset = np.nonzero(bits)
            change = np.zeros(len(raw) + 1, dtype=np.int64)
            starts = np.unique(at[seg] + offset)
            change[starts] += 1
            np.subtract.at(change, starts + SPAN, 1)
            gone = np.cumsum(change[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
            out.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        removed, spans, sha = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "h", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Null, empty and short texts lose nothing. Rows of one doc_id do not remove from each other; a null
    doc_id is larger than all others. An empty table gives an empty result; other columns are not read."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body()).alias("h"), body().alias("text"))
    size = F.octet_length("text").cast("long")
    base = staged(docs.select("doc_id", "h", size.alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "repeat-rows")
    total = base.agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    blocks = int((total["bytes"] or 0) // 17 // BLOCK_MARKS + 1)  # a mark for about 17 bytes
    groups = max(int(total["rows"] // GROUP_DOCUMENTS + 1), blocks)
    back = "part long, ids binary, hs binary, owner binary, "
    packed = docs.where(size >= SPAN).mapInArrow(_marks(blocks, groups, int(total["bytes"] or 0)), "block int, ids binary, hs binary, owner binary, low binary")
    shared = packed.groupBy("block").applyInPandas(_shared(groups), back + "low binary")
    shared = staged(shared.groupBy("part").applyInPandas(_per_document({"low": np.uint32}), "doc_id long, h long, low binary"), "repeat-marks")
    entries = shared.agg(F.sum(F.octet_length("low") / 4)).first()[0] or 0
    often = shared.where("low is null").select("doc_id", "h").collect()  # at most a mark for HOT / 2 segments
    hot = np.sort(np.array([r["doc_id"] for r in often], dtype=np.int64).view(np.uint64))
    entries += sum(r["h"] for r in often)
    wanted = shared.where("low is not null").select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "low")
    held = docs.join(wanted, (docs.h == F.col("__h")) & docs.doc_id.eqNullSafe(F.col("__id"))).select("doc_id", "h", "text", "low")

    shards = int(entries // SHARD_SEGMENTS + 1)
    kinds = "shard int, ids binary, hs binary, owner binary, first binary, count binary, mask binary, text binary"
    sent = held.mapInArrow(_segments(shards, groups, hot), kinds)
    decided = sent.groupBy("shard").applyInPandas(_decide(groups), back + "first binary, mask binary")
    per_document = _per_document({"first": np.uint32, "mask": np.uint64})
    masks = staged(decided.groupBy("part").applyInPandas(per_document, "doc_id long, h long, first binary, mask binary"), "repeat-masks")
    masks = masks.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "first", "mask")
    cut = docs.join(masks, (docs.h == F.col("__h")) & docs.doc_id.eqNullSafe(F.col("__id"))).select("doc_id", "h", "text", "first", "mask")
    done = staged(cut.mapInArrow(_cleaned, "doc_id long, h long, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["doc_id", "h"]), "repeat-result")
    done = done.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "n_removed", "n_spans", "kept_sha256")
    out = base.join(done, (base.h == F.col("__h")) & base.doc_id.eqNullSafe(F.col("__id")), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
