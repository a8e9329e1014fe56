"""Phrase collocations over a weighted de Bruijn graph.

The longest grams of a text are edges between the shorter grams that overlap in them; only these edges are
counted, one per word position. Where a piece ends, the edges there are cut short. Counts of shorter phrases
follow from the flow through the nodes: as often as a node stands in the text, an edge leaves it or a piece ends
there, so f(node) is the sum of its outgoing edges plus the short edges that end in it, level by level down to
single words. A phrase that is not at a fork - one of its extensions by a word stands as often as itself - lies
on an unary path, which is compacted to its longest phrases.

Two passes read the text. The first counts word pairs by a hash, as packed arrays dealt by ranges of the hash,
and marks pairs that may reach ``min_count`` in a bitmap of fixed size (``BITMAP`` bits, the only thing that
goes through the driver). In the second an edge also ends where a pair cannot reach the count: no phrase over it
can either, and the flow is corrected there as at the end of a piece. Marks that hashes share only let more
edges through; every count is exact.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, worker_state
from .tokens import slices

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
BITMAP = 27  # the bitmap of frequent pairs has 2^27 bits, 16 MB, whatever the size of the table
RANGE_BYTES = 1 << 22  # text that one hash range of the pair counts stands for
KEPT_WORDS = 300_000  # words a worker remembers
ROWS, CHARS = 256, 1 << 20  # rows of a batch and characters that are taken at a time
HELD_PAIRS = 2_000_000  # pairs a task holds before it sorts and sends them
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
LOWER = bytes(10 if c in PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
SKIP, END = 0, 1  # ids of the empty word and the end of a piece


class Words(dict):
    """Ids of words in order of appearance, with a hash of each."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []
        self.codes = array("Q")
        self.ids([b"", b"\n"])

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self.names)
        self.names.append(word)
        self.codes.append(xxhash.xxh3_64_intdigest(word))
        return new

    def ids(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        self.hashes = np.array(self.codes, np.uint64)
        return found


def read(words: Words, texts: list[str]) -> np.ndarray:
    """Word ids of the texts in order, ``END`` between pieces and around the texts."""
    raw = b"\n".join(t.encode() for t in texts).translate(LOWER)
    found = words.ids(b"\n".join((b"", raw, b"")).replace(b"\n", b" \n ").split(b" "))
    return found[found != SKIP]


def pair_hashes(words: Words, ids: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions whose next word is in the same piece, hash of the pair and language there)."""
    here = np.flatnonzero((ids[:-1] != END) & (ids[1:] != END))
    a, b = words.hashes[ids[here]], words.hashes[ids[here + 1]]
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(seed)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return here, x


def by_language(batch: pa.RecordBatch):
    """(language, texts) of a batch, in slices of bounded size."""
    for start in range(0, batch.num_rows, ROWS):
        some = batch.slice(start, ROWS)
        rows: dict[str, list[str]] = {}
        for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
            rows.setdefault(lang, []).append(text)
        for lang, held in rows.items():
            for part in slices(held, CHARS):
                yield lang, part


def words_of(name: str = "collocation_words") -> Words:
    box = worker_state(name, dict)
    if len(box.get("words", ())) > KEPT_WORDS or "words" not in box:
        box["words"] = Words()
    return box["words"]


def pair_counts(rows: DataFrame, bits: int, min_count: int) -> DataFrame:
    """(range, keys, counts): hashed pairs of a part of the text, sorted and packed per range of the hash."""
    kind = np.uint8 if min_count < 256 else np.uint32

    def run(batches):
        held, size = [], 0

        def packed():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            n = np.minimum(n, np.iinfo(kind).max).astype(kind)
            part = (pairs >> np.uint64(64 - bits)).astype(np.int64)
            key = ((pairs >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(starts[1:], len(part))
            return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int64()), pa.array([key[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                                               pa.array([n[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())], ["range", "keys", "counts"])

        for batch in batches:
            for lang, texts in by_language(batch):
                words = words_of()
                held.append(pair_hashes(words, read(words, texts), xxhash.xxh3_64_intdigest(lang.encode()))[1])
                size += len(held[-1])
                if size > HELD_PAIRS:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    return rows.mapInArrow(run, "range long, keys binary, counts binary")


def frequent_pairs(rows: DataFrame, min_count: int, bitmap: int = BITMAP) -> bytes:
    """Bitmap of the hashes of all pairs that stand at least ``min_count`` times."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(4, int(size // RANGE_BYTES).bit_length()), 20)
    width = (1 << (bitmap - bits)) // 8
    kind = np.uint8 if min_count < 256 else np.uint32

    def merge(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint32)
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), kind)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        often = keys[starts][np.add.reduceat(counts, starts) >= min_count]
        marks = np.zeros(width * 8, np.uint8)
        marks[often >> np.uint32(32 - (bitmap - bits))] = 1
        return pa.table({"range": [table["range"][0].as_py()] if len(often) else pa.array([], pa.int64()), "marks": [np.packbits(marks).tobytes()] if len(often) else pa.array([], pa.binary())})

    found = pair_counts(rows, bits, min_count).groupBy("range").applyInArrow(merge, "range long, marks binary")
    out = bytearray(width << bits)
    for r in found.toLocalIterator():  # 2^BITMAP bits in all
        out[r["range"] * width : (r["range"] + 1) * width] = r["marks"]
    return bytes(out)


def edges(rows: DataFrame, frequent: bytes, max_words: int, bitmap: int = BITMAP) -> DataFrame:
    """(lang, gram, words, n): for every word position the longest gram that starts there and is not cut short
    by the end of its piece or a pair that is not frequent, counted per part of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        marks = np.frombuffer(shared.value, np.uint8)
        single: dict[str, np.ndarray] = {}
        words = words_of()

        def record(lang, columns, lengths, counts):
            names = pa.array(words.names, pa.binary())
            parts = [names.take(pa.array(c, mask=c == SKIP)) for c in columns]
            grams = pc.binary_join_element_wise(*parts, b" ", null_handling="skip") if len(parts) > 1 else parts[0]
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), grams.cast(pa.string()), pa.array(lengths, pa.int32()), pa.array(counts, pa.int64())], ["lang", "gram", "words", "n"])

        def alone():
            for lang, counts in single.items():
                ids = np.flatnonzero(counts)
                yield record(lang, [ids], np.ones(len(ids), np.int32), counts[ids])

        for batch in batches:
            for lang, texts in by_language(batch):
                if words_of() is not words:
                    yield from alone()
                    single, words = {}, words_of()
                ids = read(words, texts)
                here, pairs = pair_hashes(words, ids, xxhash.xxh3_64_intdigest(lang.encode()))
                bit = pairs >> np.uint64(64 - bitmap)
                often = (marks[bit >> np.uint64(3)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1
                goes_on = np.zeros(len(ids) + max_words, bool)
                goes_on[here[often == 1]] = True
                length = np.ones(len(ids), np.int64)
                run_on = np.ones(len(ids), bool)
                for k in range(max_words - 1):
                    run_on &= goes_on[k : k + len(ids)]
                    length += run_on
                lone = np.bincount(ids[(length == 1) & (ids != END)], minlength=len(words.names))
                if lang in single:
                    lone[: len(single[lang])] += single[lang]
                single[lang] = lone
                at = np.flatnonzero(length > 1)
                if not len(at):
                    continue
                padded = np.append(ids, np.full(max_words, SKIP))
                grams = [np.where(length[at] > k, padded[at + k], SKIP) for k in range(max_words)]
                order = np.lexsort(grams[::-1])
                grams = [g[order] for g in grams]
                new = np.ones(len(at), bool)
                new[1:] = np.logical_or.reduce([g[1:] != g[:-1] for g in grams])
                starts = np.flatnonzero(new)
                yield record(lang, [g[starts] for g in grams], length[at][order][starts], np.diff(np.append(starts, len(at))))
        yield from alone()

    return rows.mapInArrow(run, "lang string, gram string, words int, n long")


def phrase_counts(rows: DataFrame, min_count: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) with f >= min_count, (lang, n)) from the flow through the graph."""
    graph = edges(rows, frequent_pairs(rows, min_count), max_words)
    graph = staged(graph.groupBy("lang", "gram", "words").agg(F.sum("n").alias("n")), "phrase-edges")
    level, often = graph.where(F.col("words") == max_words).select("lang", "gram", "n"), []
    often.append(level.where(F.col("n") >= min_count).withColumn("words", F.lit(max_words)))
    for k in range(max_words - 1, 0, -1):
        out = level.select("lang", F.substring_index("gram", " ", k).alias("gram"), "n")
        cut = graph.where(F.col("words") == k).select("lang", "gram", "n")
        level = staged(out.unionByName(cut).groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"phrase-flow-{k}")
        often.append(level.where(F.col("n") >= min_count).withColumn("words", F.lit(k)))
    table = often[0]
    for more in often[1:]:
        table = table.unionByName(more)
    totals = level.groupBy("lang").agg(F.sum("n").alias("n"))
    return staged(table.select("lang", F.col("gram").alias("phrase"), "words", F.col("n").alias("f")), "phrases"), totals


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of 2 to ``max_words`` words of every language: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null lang is `und`; repeated rows count each time, texts without words add nothing,
    and an empty table gives an empty result. Ties of score and count go by the phrase's bytes. Further columns
    and doc_id are not read. Scores are exact (integers of up to 38 digits)."""
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    phrases, totals = phrase_counts(rows, min_count, max_words)
    wide = "decimal(38,0)"
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cuts = cuts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    score = F.expr(f"cast((cast(1000 as {wide}) * cast(a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide})) as bigint)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    # an extension by one word that stands as often: the phrase lies inside an unary path
    longer = phrases.where("words > 2")
    left = F.expr("substring_index(phrase, ' ', words - 1)")
    right = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    inside = longer.select("lang", F.explode(F.array(left, right)).alias("phrase"), F.col("f").alias("a"))
    best = best.join(inside, ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("low.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))
