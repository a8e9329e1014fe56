"""Token counts by rank-synchronous merging over ragged numpy arrays.

A text is cut before each space that a non-space follows. Such a cut is always a boundary of the
tokenizer's own split (white space before a word is one token without its last space), so the pieces can be
counted apart. Each Python worker keeps the counts of pieces it has seen, up to a bound; the pieces that are
new in a slice of texts are split into pre-tokens and merged together: one flat array of symbols, one
segment per pre-token, in each round the lowest-rank pair of every segment, all at the same time. What is
left of a segment when no pair merges is its number of tokens.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, worker_state

SLICE_CHARS = 4_000_000  # texts whose new pieces are merged together
KEPT_PIECES, KEPT_CHARS = 800_000, 24_000_000  # bound of what a worker remembers
CUT = re.compile(r" (?=\S)")
IRREGULAR = re.compile(r" (?:\s|$)")
NONE = np.int64(1 << 40)
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the split of byte-level BPE vocabularies


def pieces(text: str) -> list[str]:
    """The text cut at spaces before non-spaces; every piece but the first lost its leading space."""
    return CUT.split(text) if IRREGULAR.search(text) else text.split(" ")


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others for the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Merger:
    """The merge table of a byte-level BPE vocabulary file (tokenizers JSON)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = max(vocab.values()) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.into = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.bytes = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        self.split = regex.compile(PRE_TOKEN).findall

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def survivors(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty pre-token."""
        left = np.array([len(t) for t in tokens], dtype=np.int64)
        symbol = self.bytes[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        owner, size = np.arange(len(tokens)), left.copy()
        rank = np.full(len(symbol), NONE)
        if len(symbol) > 1:
            rank[:-1] = self.rank(symbol[:-1], symbol[1:])
        rank[np.cumsum(size) - 1] = NONE  # the last symbol of a segment has no right neighbour in it
        while len(owner):
            start = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, start)
            going = best < NONE
            left[owner[~going]] = size[~going]
            inside = np.repeat(going, size)
            symbol, rank = symbol[inside], rank[inside]
            owner, size, best = owner[going], size[going], best[going]
            if not len(owner):
                break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            first = np.ones(len(hit), dtype=bool)  # of overlapping hits (x x x) every second one from the left
            first[1:] = np.diff(hit) != 1
            lead = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - lead) % 2 == 0]
            symbol[hit] = self.into[rank[hit]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hit + 1] = False
            size = np.add.reduceat(keep, np.cumsum(size) - size, dtype=np.int64)
            place = np.cumsum(keep) - 1
            symbol, rank = symbol[keep], rank[keep]
            last = np.cumsum(size) - 1
            touched = place[hit]
            touched = np.unique(np.concatenate([touched, np.maximum(touched - 1, 0)]))
            touched = touched[touched < len(symbol) - 1]
            rank[touched] = self.rank(symbol[touched], symbol[touched + 1])
            rank[last] = NONE
        return left


class Counter:
    """Counts of pieces, remembered up to a bound; ``known[0]`` for pieces that begin a text, ``known[1]``
    for pieces with a leading space."""

    def __init__(self, path: str):
        self.merger = Merger(path)
        self.known: tuple[dict, dict] = ({}, {})
        self.chars = 0

    def learn(self, which: int, new: list[str]) -> None:
        if not new:
            return
        lead = " " if which else ""
        tokens: list[bytes] = []
        spans = []
        for p in new:
            found = self.merger.split(lead + p)
            spans.append(len(found))
            tokens += [t.encode("utf-8", "surrogatepass") for t in found]
        counts = np.zeros(len(new), dtype=np.int64)
        if tokens:
            np.add.at(counts, np.repeat(np.arange(len(new)), spans), self.merger.survivors(tokens))
        self.known[which].update(zip(new, counts.tolist()))
        self.chars += sum(map(len, new))

    def count(self, texts: list[str]) -> list[int]:
        if self.chars > KEPT_CHARS or len(self.known[1]) > KEPT_PIECES:
            self.known, self.chars = ({}, {}), 0
        cut: list[list[list[str]]] = []
        extra = []
        for text in texts:
            parts, specials = [text], 0
            for s in self.merger.special:
                if s in text:
                    again = [q for p in parts for q in p.split(s)]
                    specials += len(again) - len(parts)
                    parts = again
            cut.append([pieces(p) for p in parts])
            extra.append(specials)
        self.learn(0, list({p[0] for parts in cut for p in parts} - self.known[0].keys()))
        rest: set[str] = set()
        for parts in cut:
            for p in parts:
                rest.update(p[1:])
        self.learn(1, list(rest - self.known[1].keys()))
        first, later = self.known[0].__getitem__, self.known[1].__getitem__
        return [x + sum(first(p[0]) + sum(map(later, p[1:])) for p in parts) for x, parts in zip(extra, cut)]


def slices(texts: list[str], chars: int = SLICE_CHARS):
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    run: list[str] = []
    size = 0
    for t in texts:
        if run and size + len(t) > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, in one narrow pass.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, the same on every
    executor. Strings of special tokens inside a text count as that one token. Null and empty texts have
    no tokens; doc_ids (null, repeated) pass through; other columns are not read."""

    def run(batches):
        counter = worker_state(f"bpe_{zlib.crc32(tokenizer.encode())}", lambda: Counter(tokenizer))
        for batch in batches:
            counts = [n for part in slices(batch.column(1).to_pylist()) for n in counter.count(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select("doc_id", body().alias("text"), F.octet_length(body()).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
