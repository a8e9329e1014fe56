"""Second-order boosted trees on histograms, several models at a time.

A fleet of boosters (variants, or the trials of a search) grows over one binned copy of the matrix. Where the rows are
few, or there are several models and a task can hold all rows within a bound, a task grows a model whole (``whole``): the
jobs of a level would cost more than its sums. Else one Spark job takes every live model a step further: each task brings
its rows' margins up to date, sends per (model, node) the sums of gradient, hessian and rows of every feature's bins, and
one group per (model, node) adds the tasks' sums up and finds the best regularised split. Only splits and metric sums
reach the driver, never histograms or rows. The model number is part of the grouping key, so a level of several models is
one job. Where all columns together have few joint bins for so many rows, rows of equal bins are a cell: they share a
margin, and a tree walks cells.

Growth: ``depth`` splits every leaf of a level; ``leaf`` splits the leaf of highest gain until there are
``leaves`` of them (the splits of leaves that may come next are asked for ahead, so a tree takes about as many
jobs as it is deep); ``symmetric`` takes one split for all leaves of a level, and a row's leaf is a bit code.

The metric on the validation split comes with the next tree's first job. A model stops after ``patience`` rounds
without gain and is cut to its best round; no trees at all is a candidate, too.

The matrix is a table of blocks of rows in the shared folder. Margins are written with it every ``RESTAGE``
rounds; between, tasks apply the trees since then. A worker remembers margins it has computed, up to
``KEPT_BYTES``; a task on another worker finds the same ones from the table and the trees.
"""

from __future__ import annotations

import json
import math
import sys
import time
import types
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ... import constants as C
from ...session import scratch_path
from .sums import Binned

MAX_BINS = 64
BLOCK_ROWS = 8192
RESTAGE = 25  # rounds after which margins are written again
PART_ROWS = 200_000  # rows that one task takes alone; more are dealt evenly over the cores
TASK_ROWS = 600_000  # rows that a task of a job takes, at most
CHUNK_ROWS = 200_000  # rows that a task works on at a time
NODES = 32  # nodes of a model whose histograms one job takes
KEYS = 16  # (model, node) whose sums one task adds up
KEPT_BYTES = 128 << 20
MOST_CELLS = 4  # joint bins of all columns, for each row, up to which rows of equal bins are put together
WHOLE_BYTES, CORE_BYTES = 1 << 30, 512 << 20  # that a task may take for all rows of a model, and all of them on average
ROUNDS, PATIENCE = 1000, 100
VALID = 1  # mark of a validation row
MOST_FOLDS = 254  # marks are one byte
HESSIAN_FLOOR = 1e-3  # least sum of hessians of a leaf where no larger one is asked for


@dataclass(frozen=True)
class TreeParams:
    growth: str = "depth"  # depth, leaf or symmetric
    rate: float = 0.05
    max_depth: int = 6  # no limit if below 0
    leaves: int = 31  # of leaf-wise growth
    alpha: float = 0.0  # L1 on leaf weights
    lam: float = 1.0  # L2
    min_weight: float = HESSIAN_FLOOR  # sum of hessians of a leaf, at least
    min_rows: int = 1
    row_share: float = 1.0
    row_every: int = 1  # rounds for which a sample of rows is kept
    column_share: float = 1.0  # of a tree's columns
    objective: str = "squared"  # or smape
    rounds: int = ROUNDS
    patience: int | None = PATIENCE
    seed: int = C.RANDOM_STATE
    fold: int | None = None  # train rows of this fold are the validation rows, those of the other folds are learned from


@dataclass
class Tree:
    feature: np.ndarray  # -1: leaf
    threshold: np.ndarray  # bin; rows up to it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, rows: np.ndarray):
        """(leaf, its rows) of these rows, as far as it has any; ``bins`` has a row per feature."""
        open_ = [(0, rows)]
        while open_:
            node, rows = open_.pop()
            f = self.feature[node]
            if f < 0:
                yield node, rows
                continue
            low = bins[f].take(rows) <= self.threshold[node]
            for child, side in ((self.right[node], ~low), (self.left[node], low)):
                part = rows.take(np.flatnonzero(side))
                if len(part):
                    open_.append((int(child), part))

    def apply(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(bins.shape[1], np.int32)
        if len(node):
            for leaf, rows in self.leaves(bins, np.arange(len(node))):
                node[rows] = leaf
        return node


@dataclass
class LeafMasks:
    """A tree of up to 64 leaves without a walk. A bit is a leaf, from left to right; a bin takes the bits of the left side
    from every node on its feature where it goes right. The lowest bit that all features leave is the row's leaf."""

    tables: list[tuple[int, np.ndarray]]  # feature, bits by bin
    leaf_values: np.ndarray

    @staticmethod
    def of(t: Tree, sizes: list[int]) -> "LeafMasks | None":
        if (t.feature < 0).sum() > 64 or not hasattr(np, "bitwise_count"):
            return None
        feature, left, right = t.feature.tolist(), t.left.tolist(), t.right.tolist()
        tables: dict[int, np.ndarray] = {}
        values: list[float] = []
        stack = [(0, 0, False)]  # node, first leaf under it, whether its left side is done
        while stack:
            node, first, seen = stack.pop()
            f = feature[node]
            if f < 0:
                values.append(float(t.value[node]))
            elif not seen:
                stack += [(node, len(values), True), (left[node], 0, False)]
            else:
                bits = tables.setdefault(f, np.full(sizes[f], 2**64 - 1, np.uint64))
                bits[t.threshold[node] + 1 :] &= np.uint64(2**64 - 1 - ((1 << len(values)) - (1 << first)))
                stack.append((right[node], 0, False))
        return LeafMasks(sorted(tables.items()), np.array(values))

    def values(self, bins: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.full(bins.shape[1], self.leaf_values[0])
        bits = None
        for f, table in self.tables:
            x = table.take(bins[f])
            bits = x if bits is None else np.bitwise_and(bits, x, out=bits)
        return self.leaf_values.take(np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)))


@dataclass
class HistModel:
    """A fitted model: ``trees`` up to the best round. ``edges[f]`` are the upper bounds of feature f's bins."""

    params: TreeParams
    init: float
    columns: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]
    history: list[tuple[int, float, float, float]] = field(default_factory=list)  # round, rmse, smape on validation, smape on train
    importance: np.ndarray | None = None

    @property
    def best_iteration(self) -> int:
        return len(self.trees)

    def at_best(self) -> tuple[int, float, float, float]:
        return self.history[self.best_iteration]

    def score(self, x: np.ndarray, masks: list[LeafMasks | None] | None = None) -> np.ndarray:
        """Predictions of raw features (rows, columns); ``masks`` are those of ``masks_of``, for who asks many times."""
        bins = np.stack([np.searchsorted(e, x[:, i]).astype(np.uint8) for i, e in enumerate(self.edges)]) if len(self.edges) else np.zeros((0, len(x)), np.uint8)
        out = np.full(len(x), self.init)
        for t, m in zip(self.trees, self.masks_of() if masks is None else masks):
            out += t.value[t.apply(bins)] if m is None else m.values(bins)
        return out

    def masks_of(self) -> list[LeafMasks | None]:
        return [LeafMasks.of(t, [len(e) + 1 for e in self.edges]) for t in self.trees]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction of its ``features`` vector or of its columns; rows go through in Arrow batches."""
        from pyspark.ml.functions import vector_to_array

        x = vector_to_array("features") if "features" in df.columns else F.array(*[F.col(c).cast("double") for c in self.columns])
        model = HistModel(self.params, self.init, self.columns, self.edges, self.trees)
        masks: list = []

        @F.pandas_udf("double")
        def predict(values):
            import pandas as pd

            masks[:] = masks or model.masks_of()  # once a task
            return pd.Series(model.score(np.stack(values.to_numpy()), masks) if len(values) else np.zeros(0))

        return df.withColumn(out, predict(x))

    def expression(self, x: Column) -> Column:
        """Symmetric trees as one expression of the features array, for where there is no Python: per tree, the bits of its
        conditions are the place in its array of leaf values."""
        trees = []
        for t in self.trees:
            splits, node = [], 0
            while t.feature[node] >= 0:
                splits.append((int(t.feature[node]), float(self.edges[t.feature[node]][t.threshold[node]])))
                node = int(t.left[node])
            values = []
            for code in range(1 << len(splits)):
                node = 0
                for k in range(len(splits)):
                    node = int((t.right if code >> k & 1 else t.left)[node])
                values.append(float(t.value[node]))
            trees.append({"f": [f for f, _ in splits], "b": [b for _, b in splits], "v": values})
        if not trees:
            return F.lit(self.init)
        known = F.from_json(F.lit(json.dumps(trees)), "array<struct<f: array<int>, b: array<double>, v: array<double>>>")

        def leaf(t: Column) -> Column:
            bit = lambda k: F.when(F.get(x, F.get(t["f"], k)) <= F.get(t["b"], k), F.lit(0)).otherwise(F.call_function("shiftleft", F.lit(1), k))
            places = F.sequence(F.lit(0), F.size(t["f"]) - 1)
            code = F.when(F.size(t["f"]) == 0, F.lit(0)).otherwise(F.aggregate(places, F.lit(0), lambda a, k: a + bit(k)))
            return F.get(t["v"], code)

        return F.aggregate(known, F.lit(float(self.init)), lambda a, t: a + leaf(t))

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON row."""
        state = {"params": asdict(self.params), "init": self.init, "columns": self.columns, "edges": [e.tolist() for e in self.edges], "history": self.history,
                 "importance": None if self.importance is None else self.importance.tolist(),
                 "trees": [{k: v.tolist() for k, v in vars(t).items()} for t in self.trees]}
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "HistModel":
        s = json.loads(spark.read.text(path, wholetext=False).first()[0])
        kinds = {"feature": np.int32, "threshold": np.int32, "left": np.int32, "right": np.int32, "value": np.float64}
        trees = [Tree(**{k: np.array(v, kinds[k]) for k, v in t.items()}) for t in s["trees"]]
        importance = None if s["importance"] is None else np.array(s["importance"])
        return HistModel(TreeParams(**s["params"]), s["init"], s["columns"], [np.array(e) for e in s["edges"]], trees, [tuple(h) for h in s["history"]], importance)


# ---- sums, splits, leaf weights -----------------------------------------------------------------


def soft(g, alpha: float):
    """Gradient sums shrunk by the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_weight(g, h, p: TreeParams):
    return -soft(g, p.alpha) / (h + p.lam)


def strength(g, h, p: TreeParams):
    """Twice the loss that the best weight of a leaf takes off."""
    return soft(g, p.alpha) ** 2 / np.maximum(h + p.lam, 1e-300)


def gradients(margin: np.ndarray, label: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    """M05 for arrays, and the squared loss."""
    if objective == "squared":
        return margin - label, np.ones(len(label))
    eps = C.SMAPE_EPS
    p, t = np.maximum(np.expm1(margin), eps), np.maximum(np.expm1(label), eps)
    d, s = p - t, p + t + eps
    return (2 * np.sign(d) / s - 2 * np.abs(d) / (s * s)) * p, np.clip(2 * p * p / (s * s), *C.HESSIAN_CLIP)


def best_split(sums: np.ndarray, p: TreeParams) -> tuple | None:
    """(gain, feature, bin, left sums, sums of the node) of the best valid split; ``sums``: (3, features, bins).
    Of equal gains the first feature's first bin counts."""
    left = np.cumsum(sums, axis=2)
    whole = left[:, :1, -1:]
    right = whole - left
    ok = (left[1] >= p.min_weight) & (right[1] >= p.min_weight) & (left[2] >= p.min_rows) & (right[2] >= p.min_rows)
    gain = np.where(ok, 0.5 * (strength(left[0], left[1], p) + strength(right[0], right[1], p) - strength(whole[0], whole[1], p)), -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, sums.shape[2])
    return (float(gain[f, b]), f, b, left[:, f, b], whole[:, 0, 0]) if gain[f, b] > 1e-12 else None


def best_level_split(sums: np.ndarray, p: TreeParams) -> tuple | None:
    """The split of highest total gain over the nodes of a level; ``sums``: (nodes, 3, features, bins)."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    gain = 0.5 * (strength(left[:, 0], left[:, 1], p) + strength(right[:, 0], right[:, 1], p) - strength(whole[:, 0], whole[:, 1], p)).sum(axis=0)
    ok = (left[:, 2].min(axis=0) >= 0) & (left[:, 2].sum(axis=0) >= p.min_rows) & (right[:, 2].sum(axis=0) >= p.min_rows)
    gain = np.where(ok, gain, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, sums.shape[3])
    return (float(gain[f, b]), f, b, left[:, :, f, b], whole[:, :, 0, 0]) if gain[f, b] > 1e-12 else None


# ---- the binned matrix --------------------------------------------------------------------------


def bin_edges(train: DataFrame, columns: list[str], max_bins: int) -> list[np.ndarray]:
    """Per feature up to ``max_bins`` - 1 upper bounds of bins: quantiles of the training rows, one aggregate."""
    if not columns:
        return []
    shares = [i / max_bins for i in range(1, max_bins)]
    row = train.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(q if q is not None else [], dtype=np.float64)) for q in row]


def block_table(matrix: DataFrame, columns: list[str], edges: list[np.ndarray], label: str, split: str, fold: str | None = None, cells: int | None = None) -> DataFrame:
    """(block, n, bins, runs, label, mark, margins): rows in blocks, bins one byte each, feature by feature. The mark is
    `VALID` or else, of a training row, its fold above that (0 without folds).

    With ``cells`` (parts) the rows are ordered by their bins first, those of a cell (equal bins) by a hash of the label, so
    that a cell of any size may lie in several parts: bins are then there once a cell, and ``runs`` are its rows."""
    sizes = [len(e) + 1 for e in edges]

    def binned(x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]) if edges else np.zeros((0, len(x)), np.int64)

    def celled(batches):
        for batch in batches:
            label, mark, *x = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns)
            cell = np.ravel_multi_index(tuple(binned(np.column_stack(x))), sizes).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (label, mark, cell)], ["label", "mark", "cell"])

    def run(batches):
        import pyspark

        part = pyspark.TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        number = 0

        def packed(rows: np.ndarray):
            nonlocal number
            if cells:
                starts = np.flatnonzero(np.diff(rows[:, 2], prepend=-1))
                bins, runs = np.stack(np.unravel_index(rows[starts, 2].astype(np.int64), sizes)).astype(np.uint8), np.diff(np.append(starts, len(rows))).tobytes()
            else:
                bins, runs = binned(rows[:, 2:]).astype(np.uint8), b""
            row = [part << 32 | number, len(rows), bins.tobytes(), runs, rows[:, 0].tobytes(), rows[:, 1].astype(np.uint8).tobytes(), b""]
            number += 1
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["block", "n", "bins", "runs", "label", "mark", "margins"])

        for batch in batches:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]))
            if sum(map(len, held)) >= BLOCK_ROWS:
                rows = np.concatenate(held)
                for at in range(0, len(rows) - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield packed(rows[at : at + BLOCK_ROWS])
                held = [rows[len(rows) - len(rows) % BLOCK_ROWS :]]
        if held and len(rest := np.concatenate(held)):
            yield packed(rest)

    rows = matrix.where(F.col(split).isin("train", "validation"))
    train = F.lit(0) if fold is None else F.coalesce(F.col(fold).cast("int") + VALID + 1, F.lit(0))
    rows = rows.select(F.col(label).cast("double"), F.when(F.col(split) == "validation", VALID).otherwise(train).cast("double"), *[F.col(f"`{c}`").cast("double") for c in columns])
    if cells:
        rows = rows.mapInArrow(celled, "label double, mark double, cell double").withColumn("at", F.xxhash64("label", "mark"))
        rows = rows.repartitionByRange(cells, "cell", "at").sortWithinPartitions("cell", "at").drop("at")
    return rows.mapInArrow(run, "block long, n long, bins binary, runs binary, label binary, mark binary, margins binary")


# ---- what a task does ---------------------------------------------------------------------------


@dataclass
class Step:
    """What a job does for one model."""

    model: int
    params: TreeParams
    init: float
    slot: int  # place in the stored margins, -1 where none are stored
    stored: int  # rounds that the stored margins hold
    trees: list[Tree]  # of the rounds since
    tree: Tree  # grown so far
    nodes: list[int]  # whose sums are wanted
    columns: np.ndarray
    measure: bool  # metric sums of the finished rounds

    @property
    def round(self) -> int:
        return self.stored + len(self.trees)


def kept_margins() -> dict:
    """Margins that a worker keeps between tasks (the package is pickled by value, module globals do not last)."""
    box = sys.modules.setdefault("_pricelab_margins", types.ModuleType("_pricelab_margins"))
    if not hasattr(box, "held"):
        box.held, box.size = {}, 0
    return box


def margins_of(run: tuple[str, int], blocks: tuple, bins: np.ndarray, stored: np.ndarray, step: Step) -> np.ndarray:
    box, key = kept_margins(), (run, blocks, step.model)
    for old in [k for k in box.held if k[0][0] == run[0] and k[0] != run]:  # of blocks that have been dealt anew
        box.size -= box.held.pop(old)[1].nbytes
    known = box.held.get(key)
    if known is not None and step.stored <= known[0] <= step.round:
        start, margin = known[0], known[1].copy()
    else:
        start, margin = step.stored, stored[step.slot].copy() if step.slot >= 0 else np.full(bins.shape[1], step.init)
    for tree in step.trees[start - step.stored :]:
        margin += tree.value[tree.apply(bins)]
    if known is None:
        box.size += margin.nbytes
        if box.size > KEPT_BYTES:
            box.held, box.size = {}, margin.nbytes
    box.held[key] = (step.round, margin)
    return margin


def rows_of(mark: np.ndarray, p: TreeParams) -> tuple[np.ndarray, np.ndarray]:
    """Which rows a model is measured on, and which it may learn from."""
    valid = mark == (VALID if p.fold is None else VALID + 1 + p.fold)
    return valid, ~valid & (mark != VALID)


@dataclass
class Chunk:
    """Blocks as one. A column of ``bins`` and a margin belong to a row or, where there are ``runs``, to the rows of a cell."""

    blocks: tuple
    sizes: tuple  # rows of each
    bins: np.ndarray
    runs: np.ndarray | None
    label: np.ndarray
    mark: np.ndarray
    stored: np.ndarray  # margins
    cells: tuple  # columns of ``bins`` of each block

    def __post_init__(self):
        self.first = None if self.runs is None else np.cumsum(self.runs) - self.runs

    def of_cells(self, values: np.ndarray) -> np.ndarray:
        """Sums of the rows' values."""
        return np.add.reduceat(values, self.first, dtype=np.float64)

    def of_rows(self, values: np.ndarray) -> np.ndarray:
        return values if self.runs is None else np.repeat(values, self.runs)


def joined(rows: list) -> Chunk:
    block, n, bins, runs, label, mark, *margins = zip(*rows)
    runs = [np.frombuffer(x, np.int64) for x in runs]
    cells = tuple(len(r) or k for r, k in zip(runs, n))
    side = lambda parts, kind, sizes: np.concatenate([np.frombuffer(x, kind).reshape(-1, k) for x, k in zip(parts, sizes)], axis=1)
    stored = side(margins[0], np.float64, cells) if margins else np.zeros((0, sum(cells)))
    return Chunk(block, n, side(bins, np.uint8, cells), np.concatenate(runs) if len(runs[0]) else None, side(label, np.float64, n)[0], side(mark, np.uint8, n)[0], stored, cells)


def chunks(rows):
    """Blocks, about CHUNK_ROWS rows at a time, as what a `Chunk` is made of."""
    plain = lambda c: (c.blocks, c.sizes, c.bins, c.runs, c.label, c.mark, c.stored, c.cells)
    held, size = [], 0
    for row in rows:
        if held and size + row[1] > CHUNK_ROWS:
            yield plain(joined(held))
            held, size = [], 0
        held.append(row)
        size += row[1]
    if held:
        yield plain(joined(held))


def sums_of(run: tuple[str, int], steps: list[Step], sizes: list[int]):
    """((model, node), (block, sums)): the sums of a task. Node -1: a whole level; -2: metric sums."""

    def work(part):
        out: dict[tuple[int, int], np.ndarray] = {}
        first = None
        for c in part:
            c = Chunk(*c)
            first = c.blocks[0] if first is None else first
            for s in steps:
                add(out, s, c, margins_of(run, c.blocks, c.bins, c.stored, s), sizes)
        return [(key, (first, sums.tobytes())) for key, sums in out.items()]

    return work


def add(out: dict, s: Step, c: Chunk, margin: np.ndarray, sizes: list[int]) -> None:
    """Adds the sums of a chunk: (nodes, gradient / hessian where it is not 1 / rows, columns, bins)."""
    p = s.params
    valid, learned = rows_of(c.mark, p)
    if s.measure:
        guess = c.of_rows(margin)
        with np.errstate(over="ignore", invalid="ignore"):  # a label that is no logarithm
            smape = np.abs(np.maximum(np.expm1(guess), C.SMAPE_EPS) - (truth := np.maximum(np.expm1(c.label), C.SMAPE_EPS)))
            smape /= (truth + np.maximum(np.expm1(guess), C.SMAPE_EPS)) / 2 + C.SMAPE_EPS
        v = np.flatnonzero(valid)
        got = np.array([len(v), np.square(guess.take(v) - c.label.take(v)).sum(), smape.take(v).sum(), learned.sum(), smape.take(np.flatnonzero(learned)).sum()], dtype=np.float64)
        out[s.model, -2] = out.get((s.model, -2), 0) + got
    if not s.nodes:
        return
    use = learned
    if p.row_share < 1:
        draw = [np.random.default_rng([p.seed & 0xFFFFFFFF, s.round // p.row_every, b & 0xFFFFFFFF, b >> 32]).random(n) for b, n in zip(c.blocks, c.sizes)]
        use = use & (np.concatenate(draw) < p.row_share)
    squared = p.objective == "squared"
    if c.runs is None:
        used = np.flatnonzero(use)
    else:  # a cell learns from as many rows as it has
        n = c.of_cells(use)
        used = np.flatnonzero(n)
    wanted = set(s.nodes)
    parts = {node: rows for node, rows in s.tree.leaves(c.bins, used) if node in wanted} if len(used) else {}
    rows = np.concatenate(list(parts.values())) if parts else used[:0]
    if c.runs is None:
        values = [*gradients(margin.take(rows), c.label.take(rows), p.objective)[: 1 if squared else 2], None]
    elif squared:
        values = [(n * margin - c.of_cells(np.where(use, c.label, 0.0))).take(rows), n.take(rows)]
    else:
        values = [*(c.of_cells(np.where(use, x, 0.0)).take(rows) for x in gradients(c.of_rows(margin), c.label, p.objective)), n.take(rows)]
    binned = Binned(c.bins.take(s.columns, axis=0).take(rows, axis=1), [sizes[f] for f in s.columns], max(sizes))
    found, at = {}, 0
    for node, own in parts.items():  # neighbours now
        found[node] = binned.sums(slice(at, at + len(own)), values)
        at += len(own)
    zero = np.zeros((len(values), len(s.columns), max(sizes)))
    if p.growth == "symmetric":
        out[s.model, -1] = out.get((s.model, -1), 0) + np.stack([found.get(node, zero) for node in s.nodes])
    else:
        for node in s.nodes:
            out[s.model, node] = out.get((s.model, node), 0) + found.get(node, zero)


def decided(steps: list[Step], width: int):
    """What comes of the tasks' sums of one (model, node): metric sums as they are, or the best split."""
    known = {s.model: s for s in steps}

    def decide(model: int, node: int, parts: list[bytes]) -> bytes:
        total = np.frombuffer(parts[0]).copy()
        for x in parts[1:]:
            total += np.frombuffer(x)
        if node == -2:
            return total.tobytes()
        s = known[model]
        total = total.reshape(len(s.nodes) if node == -1 else 1, -1, len(s.columns), width)
        if total.shape[1] == 2:  # the hessian is 1
            total = total[:, [0, 1, 1]]
        if node == -1:
            found = best_level_split(total, s.params)
            if found is None:
                return total[:, :, 0].sum(axis=2).tobytes() if len(s.columns) else b""
            gain, f, b, left, whole = found
            return np.concatenate([[gain, s.columns[f], b], left.ravel(), whole.ravel()]).tobytes()
        found = best_split(total[0], s.params)
        if found is None:
            return total[0, :, 0].sum(axis=1).tobytes()
        gain, f, b, left, whole = found
        return np.concatenate([[gain, s.columns[f], b], left, whole]).tobytes()

    return decide


def run_steps(data: RDD, parts: int, run: tuple[str, int], steps: list[Step], sizes: list[int]) -> dict[tuple[int, int], np.ndarray]:
    """One job."""
    work, decide = sums_of(run, steps, sizes), decided(steps, max(sizes, default=1))
    keys = sum(s.measure + (1 if s.params.growth == "symmetric" else len(s.nodes)) for s in steps)
    summed = data.mapPartitions(work).groupByKey(min(-(-keys // KEYS), parts))
    found = summed.map(lambda x: (x[0], decide(*x[0], [sums for _, sums in sorted(x[1])])))
    return {key: np.frombuffer(best) for key, best in found.collect()}  # a split per model and node


def with_margins(run: tuple[str, int], steps: list[Step]):
    """The blocks with the margins that the models have now."""

    def work(part):
        for c in part:
            c = Chunk(*c)
            rows, cells = np.cumsum(c.sizes)[:-1], np.cumsum(c.cells)[:-1]
            margins = [np.split(margins_of(run, c.blocks, c.bins, c.stored, s), cells) for s in steps]
            bins, label, mark = np.split(c.bins, cells, axis=1), np.split(c.label, rows), np.split(c.mark, rows)
            runs = [np.zeros(0, np.int64)] * len(c.blocks) if c.runs is None else np.split(c.runs, cells)
            for i, (block, n) in enumerate(zip(c.blocks, c.sizes)):
                yield block, n, *(x[i].tobytes() for x in (bins, runs, label, mark)), b"".join(m[i].tobytes() for m in margins)

    return work


# ---- growing a tree on the driver ---------------------------------------------------------------


class Growth:
    """A tree whose splits come in job by job. Nodes are numbered as they appear; ``sums`` are (g, h, rows)."""

    def __init__(self, p: TreeParams):
        self.p = p
        self.feature, self.bin, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.sums: list = [None]
        self.gain: dict[int, float] = {}  # known splits
        self.asked: set[int] = set()

    def may_split(self, node: int) -> bool:
        return self.p.max_depth < 0 or self.depth[node] < self.p.max_depth

    def split(self, node: int, f: int, b: int, left: np.ndarray, whole: np.ndarray) -> None:
        self.feature[node], self.bin[node] = f, b
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for sums in (left, whole - left):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.depth.append(self.depth[node] + 1)
            self.sums.append(sums)

    def wanted(self) -> list[int]:
        """Nodes whose best split the next job is to find; none when the tree is done."""
        leaves = [i for i in range(len(self.feature)) if self.feature[i] < 0 and i not in self.asked and (i == 0 or self.may_split(i))]
        if self.p.growth != "leaf":
            return leaves
        first = self.chosen()[1]
        if first is None:
            return []
        # ahead: children of the splits of highest gain that are not taken yet
        above = {child: self.gain.get(i, 0.0) for i, f in enumerate(self.feature) if f >= 0 for child in (self.left[i], self.right[i])}
        return sorted(leaves, key=lambda i: (i not in first, -above.get(i, 0.0), i))

    def chosen(self) -> tuple[list[int], set[int] | None]:
        """Best-first: (splits taken, leaves whose gain is not known yet) or None for these when all is decided."""
        taken, open_ = [], [0]
        while len(taken) + 1 < self.p.leaves:
            unknown = {i for i in open_ if i not in self.asked and (i == 0 or self.may_split(i))}
            if unknown:
                return taken, unknown
            best = max((i for i in open_ if i in self.gain), key=lambda i: (self.gain[i], -i), default=None)
            if best is None:
                break
            taken.append(best)
            open_.remove(best)
            open_ += [self.left[best], self.right[best]]
        return taken, None

    def take(self, nodes: list[int], found: dict[int, np.ndarray]) -> None:
        for i in nodes:
            self.asked.add(i)
            got = found.get(i)
            if got is None:
                continue
            if len(got) == 3 or not self.may_split(i):
                self.sums[i] = got[-3:]
                continue
            self.sums[i] = got[6:9]
            self.gain[i] = float(got[0])
            self.split(i, int(got[1]), int(got[2]), got[3:6], got[6:9])

    def take_level(self, nodes: list[int], got: np.ndarray | None) -> None:
        self.asked.update(nodes)
        if got is None or len(got) == 3 * len(nodes) or not self.may_split(nodes[0]):
            if got is not None:
                for i, sums in zip(nodes, got[-3 * len(nodes) :].reshape(-1, 3)):
                    self.sums[i] = sums
            return
        left, whole = got[3:].reshape(2, len(nodes), 3)
        for i, lf, wh in zip(nodes, left, whole):
            self.sums[i] = wh
            self.split(i, int(got[1]), int(got[2]), lf, wh)
        self.gain[nodes[0]] = float(got[0])

    def partial(self) -> Tree:
        a = [np.array(x, np.int32) for x in (self.feature, self.bin, self.left, self.right)]
        return Tree(*a, np.zeros(len(self.feature)))

    def value(self, node: int) -> float:
        """What a leaf adds to the margin."""
        sums = self.sums[node]
        return self.p.rate * float(leaf_weight(*(np.zeros(2) if sums is None else sums[:2]), self.p))

    def tree(self, looked_ahead: bool = True) -> Tree:
        """The finished tree: nodes that were only looked at ahead are left out."""
        taken = set(self.chosen()[0]) if self.p.growth == "leaf" and looked_ahead else {i for i, f in enumerate(self.feature) if f >= 0}
        number, out, stack = {0: 0}, [], [0]
        while stack:
            i = stack.pop()
            if i in taken:
                for child in (self.left[i], self.right[i]):
                    number[child] = len(number)
                stack += [self.right[i], self.left[i]]
            out.append(i)
        rows = sorted(out, key=number.get)
        return Tree(np.array([self.feature[i] if i in taken else -1 for i in rows], np.int32), np.array([self.bin[i] for i in rows], np.int32),
                    np.array([number[self.left[i]] if i in taken else -1 for i in rows], np.int32), np.array([number[self.right[i]] if i in taken else -1 for i in rows], np.int32),
                    np.array([0.0 if i in taken else self.value(i) for i in rows]))

    def gains(self, looked_ahead: bool = True) -> dict[int, float]:
        """Gain per feature of the splits taken."""
        out: dict[int, float] = {}
        for i in self.chosen()[0] if self.p.growth == "leaf" and looked_ahead else list(self.gain):
            out[self.feature[i]] = out.get(self.feature[i], 0.0) + self.gain[i]
        return out


@dataclass
class Booster:
    model: int
    params: TreeParams
    init: float
    features: int
    trees: list[Tree] = field(default_factory=list)
    gains: list[dict[int, float]] = field(default_factory=list)
    history: list[tuple[int, float, float, float]] = field(default_factory=list)
    growth: Growth | None = None
    columns: np.ndarray | None = None
    slot: int = -1
    stored: int = 0
    done: bool = False
    lowest: int = 0  # the best round

    def metric(self, entry: tuple) -> float:
        return entry[2] if self.params.objective == "smape" else entry[1]

    def kept(self) -> int:
        """Trees up to the best round; all of them where no round has been measured on anything."""
        return self.lowest if any(h[1] for h in self.history) else len(self.history) - 1

    def start(self) -> None:
        self.growth = Growth(self.params)
        share = self.params.column_share
        rng = np.random.default_rng([self.params.seed & 0xFFFFFFFF, len(self.trees), 7])
        n = max(1, int(round(share * self.features)))
        self.columns = np.arange(self.features) if share >= 1 else np.sort(rng.choice(self.features, n, replace=False))

    def step(self) -> Step:
        if self.growth is None:
            self.start()
        measure = len(self.history) <= len(self.trees)
        ended = len(self.trees) >= self.params.rounds or not self.features
        return Step(self.model, self.params, self.init, self.slot, self.stored, self.trees[self.stored :], self.growth.partial(), [] if ended else self.growth.wanted()[:NODES], self.columns, measure)

    def measured(self, sums: np.ndarray) -> None:
        """The metric sums of the trees so far; the model is done where they say so."""
        n, square, smape, m, train = sums.tolist()
        rmse = float(np.sqrt(square / n)) if n else 0.0
        self.history.append((len(self.trees), rmse, 100.0 * smape / n if n else 0.0, 100.0 * train / m if m else 0.0))
        patience = self.params.patience
        if self.metric(self.history[-1]) < self.metric(self.history[self.lowest]):
            self.lowest = len(self.history) - 1
        self.done = len(self.trees) >= self.params.rounds or bool(patience is not None and n and len(self.trees) - self.lowest >= patience)

    def grown(self, growth: Growth, looked_ahead: bool = True) -> None:
        self.trees.append(growth.tree(looked_ahead))
        self.gains.append(growth.gains(looked_ahead))
        if len(self.trees[-1].feature) == 1 and self.params.row_share >= 1 and self.params.column_share >= 1 and self.params.objective == "squared":
            self.done = True  # nothing to split, and the next round would be the same
        self.growth = None

    def take(self, step: Step, found: dict[tuple[int, int], np.ndarray]) -> None:
        if step.measure:
            self.measured(found[self.model, -2])
            if self.done:
                return
        if not step.nodes:
            self.done = True
            return
        if self.params.growth == "symmetric":
            self.growth.take_level(step.nodes, found.get((self.model, -1)))
        else:
            self.growth.take(step.nodes, {i: found[self.model, i] for i in step.nodes if (self.model, i) in found})
        if not self.growth.wanted():
            self.grown(self.growth)


def parts_of(rows: int, blocks: int, cores: int) -> int:
    """Tasks of a job: one for few rows, or else as many rounds of tasks on all cores as keep to TASK_ROWS."""
    if rows < PART_ROWS:
        return 1
    return max(1, min(cores * -(-rows // (cores * TASK_ROWS)), blocks))


def fits_a_task(rows: int, columns: int, models: int, cores: int) -> bool:
    """Whether a task is to take all rows of a model: they are few, or there are several models to deal and the rows take
    (bins three times, and ten numbers a row) no more than WHOLE_BYTES, and CORE_BYTES a core where models are many."""
    need = rows * (3 * columns + 80)
    return rows < PART_ROWS or (models > 1 and need <= WHOLE_BYTES and need * min(models, cores) <= CORE_BYTES * cores)


def grow_by_level(read: DataFrame, parts: int, boosters: list[Booster], sizes: list[int], until: float | None) -> None:
    """A job takes every live model a step further, over rows dealt to ``parts`` tasks."""
    spark, run = read.sparkSession, (uuid.uuid4().hex, 0)
    schema = read.schema
    data = read.repartition(parts).rdd.mapPartitions(chunks).persist(StorageLevel.MEMORY_AND_DISK)  # rebuilt from the table if an executor is lost
    while live := [b for b in boosters if not b.done]:
        steps = [b.step() for b in live]
        found = run_steps(data, parts, run, steps, sizes)
        for b, s in zip(live, steps):
            b.take(s, found)
        if until is not None and time.time() > until:
            break
        live = [b for b in live if not b.done]
        if any(len(b.trees) - b.stored >= RESTAGE for b in live):
            steps = [Step(b.model, b.params, b.init, b.slot, b.stored, b.trees[b.stored :], Growth(b.params).partial(), [], np.arange(0), False) for b in live]
            path = scratch_path(spark, "hist-blocks")
            spark.createDataFrame(data.mapPartitions(with_margins(run, steps)), schema, verifySchema=False).write.parquet(path)
            old = data
            data = spark.read.schema(schema).parquet(path).repartition(parts).rdd.mapPartitions(chunks).persist(StorageLevel.MEMORY_AND_DISK)
            old.unpersist()
            run = (run[0], run[1] + 1)
            for slot, b in enumerate(live):
                b.slot, b.stored = slot, len(b.trees)
    data.unpersist()


def fit_fleet(matrix: DataFrame, columns: list[str], fleet: list[TreeParams], label: str = "label", split: str = "split",
              max_bins: int = MAX_BINS, timeout_s: float | None = None, fold: str | None = None) -> list[HistModel]:
    """Fit all of ``fleet`` on the rows whose ``split`` is `train`, stopping each by its metric on `validation`; a model
    with a ``fold`` learns from the training rows whose column ``fold`` has another number (or none) and is stopped by the
    others. Bins are the same for all.

    Rows of other splits are not used; null or NaN features count as larger than all edges. With a time limit the
    models are cut to the best round they have reached. Without validation rows all rounds are run."""
    spark = matrix.sparkSession
    if max_bins > 256:
        raise ValueError("bins are one byte")
    began = time.time()
    train = matrix.where(F.col(split) == "train")
    edges = bin_edges(train, columns, max_bins)
    means = {r["f"]: (r["n"], r["s"]) for r in train.groupBy((F.lit(None) if fold is None else F.col(fold)).cast("int").alias("f"))
             .agg(F.count(label).alias("n"), F.sum(F.col(label).cast("double")).alias("s")).collect()}  # a row a fold
    if len(means) > MOST_FOLDS or any(f is not None and not 0 <= f < MOST_FOLDS for f in means):
        raise ValueError(f"folds are numbers from 0 to {MOST_FOLDS - 1}")

    def init_of(p: TreeParams) -> float:
        n, s = (sum(x) for x in zip((0, 0.0), *((n, s or 0.0) for f, (n, s) in means.items() if p.fold is None or f != p.fold)))
        if not n:
            raise ValueError("no training rows")
        return s / n

    inits = [init_of(p) for p in fleet]
    sizes, cores = [len(e) + 1 for e in edges], spark.sparkContext.defaultParallelism
    boosters = [Booster(i, p, float(init), len(columns)) for i, (p, init) in enumerate(zip(fleet, inits))]
    rows = matrix.where(F.col(split) == "validation").count() + sum(n for n, _ in means.values())
    whole = fits_a_task(rows, len(columns), len(fleet), cores)
    cells = parts_of(rows, rows, cores) if sizes and not whole and math.prod(sizes) <= MOST_CELLS * rows else None
    path = scratch_path(spark, "hist-blocks")
    block_table(matrix, columns, edges, label, split, fold, cells).write.parquet(path)
    read = spark.read.parquet(path)
    if whole:
        from .whole import grow_apart

        left = None if timeout_s is None else timeout_s - (time.time() - began)
        grow_apart(read.drop("margins"), boosters, sizes, left)
    else:
        grow_by_level(read, parts_of(rows, read.count(), cores), boosters, sizes, None if timeout_s is None else began + timeout_s)
    out = []
    for b in boosters:
        if not b.history:
            b.history.append((0, float("inf"), float("inf"), float("inf")))
        kept = b.kept()
        gain = np.zeros(len(columns))
        for g in b.gains[:kept]:
            for f, x in g.items():
                gain[f] += x
        importance = gain / gain.sum() if gain.sum() else gain
        out.append(HistModel(b.params, b.init, list(columns), edges, b.trees[:kept], b.history, importance))
    return out
