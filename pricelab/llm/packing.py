"""Packing documents into sequences: shortest-pack-first over the histogram of piece lengths.

One narrow pass tokenizes the documents and cuts them into pieces of at most ``capacity`` tokens (all but
the last piece of a document are full). The histogram of piece lengths has ``capacity`` entries whatever
the size of the table; packing it gives patterns (lists of lengths) with their counts. Pieces are ranked
within their length, and the rank tells the pattern, the copy of it and the place in it.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, ranked, staged, worker_state
from .tokens import PRE_TOKEN, byte_symbols, slices

CAPACITY = 1024
RANK_ROWS = 1024  # rows per bucket when pieces are ranked
MAX_BUCKETS = 65536
LONG_RUN = 2000
LONG_WHITE = re.compile(r"\s{%d}" % LONG_RUN)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, count) patterns that hold every piece of the histogram. Lengths are placed longest first,
    each into the packs with most room left; a new pack is opened only where none has room."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=-1)
            if room < length:
                pattern, n = (), left
            else:
                pattern, n = open_packs[room].pop()
                if n > left:
                    open_packs[room].append((pattern, n - left))
                if not open_packs[room]:
                    del open_packs[room]
                n = min(n, left)
            new = pattern + (length,)
            open_packs.setdefault(capacity - sum(new), []).append((new, n))
            left -= n
    return [p for room in sorted(open_packs) for p in open_packs[room]]


def runs(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, times the length is in the pattern, first sequence, offset there), sorted:
    the pieces of a length from a first rank on fill the copies of one pattern."""
    seen: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            times = lengths.count(length)
            out.append((length, seen.get(length, 0), times, sequence, offset))
            seen[length] = seen.get(length, 0) + times * count
            offset += times * length
        sequence += count
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


class Encoder:
    """Ids of texts as little-endian bytes.

    A byte-level vocabulary whose ids rise with the rank of their merges is read by tiktoken as well, to the
    same ids and several times faster. The tokenizers library itself encodes what tiktoken does not: texts with
    a special token's string, with a run of over ``LONG_RUN`` characters without (or only of) white space, for
    which tiktoken takes the square of its length, and all texts of other vocabularies. It is loaded with the
    first of them: most workers hold one vocabulary, not two."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.library = path, None
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.fast = self.ranked(spec)

    @property
    def tokenizer(self):
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def ranked(self, spec: dict):
        import tiktoken

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        byte_level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if model.get("type", "BPE") != "BPE" or not byte_level or spec.get("normalizer") or model.get("ignore_merges") or model.get("unk_token"):
            return None
        symbols = {c: b for b, c in enumerate(byte_symbols())}
        vocab = {k: v for k, v in model["vocab"].items() if k not in self.special}
        merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
        if not all(a < b for a, b in zip(merged, merged[1:])) or len(merged) + len(symbols) != len(vocab) or not vocab.keys() >= symbols.keys():
            return None
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def plain(self, text: str) -> bool:
        return not any(s in text for s in self.special) and (len(text) <= LONG_RUN or (max(map(len, text.split()), default=0) <= LONG_RUN and not LONG_WHITE.search(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self.fast is not None and self.plain(t) for t in texts]
        rest = [t for t, p in zip(texts, plain) if not p]
        other = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        return [np.array(self.fast(t) if p else next(other).ids, dtype="<u4").tobytes() for t, p in zip(texts, plain)]


def piece_table(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of every row."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encoder = worker_state(f"ids_{zlib.crc32(tokenizer.encode())}", lambda: Encoder(tokenizer))
        for batch in batches:
            row, start, length, crc, tokens = [], [], [], [], []
            i = 0
            for part in slices(batch.column(1).to_pylist()):
                for ids in encoder.encode(part):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        chunk = ids[4 * s : 4 * (s + capacity)]
                        row.append(i)
                        start.append(s)
                        length.append(len(chunk) // 4)
                        crc.append(zlib.crc32(chunk))
                        tokens.append(n)
                    i += 1
            doc_id = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_id, *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = documents.select("doc_id", body().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of all documents with the sequence that holds each and its offset there.

    A document is its ids by ``tokenizer`` and one ``end_id``, so null and empty texts are one token; every
    row, repeated or with a null doc_id, is packed on its own; an empty table gives an empty result."""
    table = staged(piece_table(documents, tokenizer, capacity, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    table_of_runs = runs(shortest_pack_first(histogram, capacity))
    names = table.columns
    buckets = min(sum(histogram.values()) // RANK_ROWS + 1, MAX_BUCKETS)
    numbered = ranked(table, "length", ["doc_id", "start"], ["doc_id", "start", "ids_crc32", "doc_tokens"], buckets)

    def seat(batches):
        first = (table_of_runs[:, 0] << 44) | table_of_runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            run = table_of_runs[np.searchsorted(first, (length << 44) | rank, side="right") - 1]
            copy, nth = np.divmod(rank - run[:, 1], run[:, 2])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(run[:, 3] + copy), pa.array(run[:, 4] + nth * length)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{n} {t}" for n, t in table.dtypes)
    return numbered.mapInArrow(seat, f"{kinds}, sequence_id long, offset long")
