"""Whole models grown by one task.

The models of a fleet do not depend on each other. Where a task can hold all rows, and there are models for all cores
(or too few rows to deal), a task takes one model from its first round to its last: no sums meet, nothing is asked of
the driver, and what a task knows of its rows (margins, the rows of a node, the sums of the node above) stays with it.

Gradients are rounded to a binary fraction so small that their sums over all rows are exact. So the sums of a child are
those of its parent less its sibling's, and no order of rows or splits changes a result. Columns are counted together
as long as their bins multiply to few cells; the counts of each are sums over the others.
"""

from __future__ import annotations

import heapq
import math
import pickle
import time
import zlib

import numpy as np
from pyspark.sql import DataFrame

from ... import constants as C
from .hist import Booster, Chunk, Growth, Tree, TreeParams, best_level_split, gradients, joined, rows_of
from .sums import Binned

SLICE = 1 << 15  # rows whose metric is computed at a time
NODES = 64  # nodes whose splits are looked for at a time


def rounded(values: np.ndarray) -> tuple[np.ndarray, float]:
    """(whole numbers, unit): the values, in place, in units of a power of two, so that any sum of them is exact."""
    most = float(max(values.max(initial=0.0), -values.min(initial=0.0)))
    if not 0 < most < float("inf"):
        return values, 1.0
    bits = min(52 - math.frexp(most)[1] - len(values).bit_length(), 1000)
    values *= 2.0**bits
    return np.rint(values, out=values), 2.0**-bits


def best_splits(sums: np.ndarray, p: TreeParams) -> list[tuple | None]:
    """``best_split`` of several nodes; ``sums``: (nodes, gradient / hessian where it is not 1 / rows, columns, bins)."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    g, h, n = left[:, 0], left[:, -2] if sums.shape[1] == 3 else left[:, -1], left[:, -1]
    g0, h0, n0 = whole[:, 0], whole[:, -2] if sums.shape[1] == 3 else whole[:, -1], whole[:, -1]
    ok = (n >= p.min_rows) & (n <= n0 - p.min_rows) & (h >= p.min_weight) & (h0 - h >= p.min_weight)

    def strength(g, h):
        x = np.maximum(np.abs(g) - p.alpha, 0.0)
        x *= x
        x /= np.maximum(h + p.lam, 1e-300)
        return x

    gain = 0.5 * (strength(g, h) + strength(g0 - g, h0 - h) - strength(g0, h0))
    gain[~ok] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    out: list[tuple | None] = []
    for i, k in enumerate(at.tolist()):
        f, b = divmod(k, sums.shape[3])
        few = np.array([g[i, f, b], h[i, f, b], n[i, f, b]]), np.array([g0[i, 0, 0], h0[i, 0, 0], n0[i, 0, 0]])
        out.append((float(flat[i, k]), f, b, *few) if flat[i, k] > 1e-12 else None)
    return out


class Grower:
    """Grows one tree on the rows of a sample."""

    def __init__(self, p: TreeParams, columns: np.ndarray, binned: Binned, values: list[np.ndarray], units: list[float]):
        self.growth, self.p, self.columns, self.binned, self.values = Growth(p), p, columns, binned, values
        self.unit = np.array([*units, 1.0])[:, None, None]
        self.rows: dict[int, np.ndarray | None] = {0: None}  # of the leaves
        self.sums = {0: binned.sums(slice(None), [*values, None])}  # of leaves that may be split

    def known(self, nodes: list[int]) -> np.ndarray:
        return np.stack([self.sums[i] for i in nodes]) * self.unit

    def split(self, node: int, f: int, b: int, left: np.ndarray, whole: np.ndarray, go_on: bool) -> list[int]:
        """The children; those that may be split have their sums."""
        t, rows, above = self.growth, self.rows.pop(node), self.sums.pop(node)
        t.split(node, int(self.columns[f]), b, left, whole)
        low = (self.binned.bins[f] if rows is None else self.binned.bins[f].take(rows)) <= b
        children = [t.left[node], t.right[node]]
        for child, side in zip(children, (low, ~low)):
            at = np.flatnonzero(side)
            self.rows[child] = at if rows is None else rows.take(at)
        if not go_on or not t.may_split(children[0]):
            return []
        fewer, more = sorted(children, key=lambda i: len(self.rows[i]))
        least = 2 * self.p.min_rows if self.p.growth != "symmetric" else 0
        if len(self.rows[more]) < least:
            return []
        self.sums[fewer] = self.binned.sums(self.rows[fewer], [*self.values, None])
        self.sums[more] = above - self.sums[fewer]
        if len(self.rows[fewer]) < least:
            del self.sums[fewer]
        return [i for i in children if i in self.sums]

    def grow(self) -> Growth:
        t = self.growth
        if self.p.growth == "symmetric":
            return self.by_level()
        t.sums[0] = self.totals(0)
        new, left_over = [0] if t.may_split(0) else [], self.p.leaves - 1 if self.p.growth == "leaf" else -1
        open_: list[tuple] = []
        while left_over:
            for i in range(0, len(new), NODES):
                some = new[i : i + NODES]
                for node, found in zip(some, best_splits(self.known(some), self.p)):
                    if found is None:
                        del self.sums[node]
                    else:
                        heapq.heappush(open_, (-found[0] if self.p.growth == "leaf" else 0.0, node, found))
            if not open_:
                break
            new = []
            for _ in range(1 if self.p.growth == "leaf" else len(open_)):
                _, node, found = heapq.heappop(open_)
                left_over -= 1
                t.gain[node] = found[0]
                new += self.split(node, *found[1:], left_over != 0)
        return t

    def by_level(self) -> Growth:
        t, level = self.growth, [0]
        t.sums[0] = self.totals(0)
        while level and t.may_split(level[0]):
            sums = self.known(level)
            found = best_level_split(sums if sums.shape[1] == 3 else sums[:, [0, 1, 1]], self.p)
            if found is None:
                break
            gain, f, b, left, whole = found
            t.gain[level[0]] = gain
            for node, lf, wh in zip(level, left, whole):
                self.split(node, f, b, lf, wh, True)
            level = [child for node in level for child in (t.left[node], t.right[node])]
        return t

    def totals(self, node: int) -> np.ndarray:
        sums = (self.sums[node] * self.unit)[:, 0].sum(axis=1)
        return sums if len(sums) == 3 else sums[[0, 1, 1]]


def grow_model(b: Booster, c: Chunk, bin_counts: list[int], seconds: float | None = None) -> None:
    """All rounds of ``b`` on these rows, or as many as begin within ``seconds``. The chunk is used up."""
    p, began = b.params, time.monotonic()
    valid, learned = rows_of(c.mark, p)
    n = int(learned.sum())
    order = np.concatenate([np.flatnonzero(learned), np.flatnonzero(valid)])  # rows that are learned from come first
    bins, label = c.bins.take(order, axis=1), c.label.take(order)
    c.bins = c.label = c.mark = order = valid = None
    with np.errstate(over="ignore", invalid="ignore"):
        truth = np.maximum(np.expm1(label), C.SMAPE_EPS)
    margin, used, drawn, binned = np.full(len(label), b.init), np.arange(n), None, None
    whole = p.row_share >= 1
    while not b.done:
        b.measured(metric_sums(margin, label, truth, n))
        if b.done or not b.features or (seconds is not None and time.monotonic() - began > seconds):
            break
        b.start()
        if not whole and drawn != len(b.trees) // p.row_every:
            drawn = len(b.trees) // p.row_every
            draw = [np.random.default_rng([p.seed & 0xFFFFFFFF, drawn, k & 0xFFFFFFFF, k >> 32]).random(m) < p.row_share for k, m in zip(c.blocks, c.sizes)]
            used = np.flatnonzero(np.compress(learned, np.concatenate(draw)))
        if binned is None or not whole or p.column_share < 1:
            binned = None
            few = np.stack([bins[f, :n] if whole else bins[f, :n].take(used) for f in b.columns])
            binned = Binned(few, [bin_counts[f] for f in b.columns], max(bin_counts))
        if p.objective == "squared":
            values = [margin.take(used)]
            values[0] -= label.take(used)
        else:
            values = list(gradients(margin.take(used), label.take(used), p.objective))
        values, units = zip(*map(rounded, values))
        grower = Grower(p, b.columns, binned, list(values), list(units))
        growth = grower.grow()
        b.grown(growth, looked_ahead=False)
        step, tree = values[0], b.trees[-1]  # the gradients have done their work
        for node, rows in grower.rows.items():
            step[slice(None) if rows is None else rows] = growth.value(node)
        grower = rows = None
        rest = np.ones(len(label), bool)
        rest[used] = False
        if whole:
            margin[:n] += step
        else:
            margin[used] += step
        for leaf, rows in tree.leaves(bins, np.flatnonzero(rest)):
            margin[rows] += tree.value[leaf]
        values = step = rest = rows = None


def metric_sums(margin: np.ndarray, label: np.ndarray, truth: np.ndarray, n: int) -> np.ndarray:
    """Those of ``add``; the first ``n`` rows are learned from."""
    sums = np.zeros(5)
    sums[0], sums[3] = len(margin) - n, n
    with np.errstate(over="ignore", invalid="ignore"):
        for first, last, at in ((0, n, 4), (n, len(margin), 2)):
            for i in range(first, last, SLICE):
                here = slice(i, min(i + SLICE, last))
                guess = np.maximum(np.expm1(margin[here]), C.SMAPE_EPS)
                sums[at] += (np.abs(guess - truth[here]) / ((truth[here] + guess) / 2 + C.SMAPE_EPS)).sum()
                if at == 2:
                    sums[1] += np.square(margin[here] - label[here]).sum()
    return sums


def work_of(p: TreeParams) -> float:
    """Something that rises with the time a round takes."""
    depth = math.log2(p.leaves) + 2 if p.growth == "leaf" else p.max_depth
    return p.row_share * (1 + p.column_share * (min(depth, p.max_depth) if p.max_depth >= 0 else depth))


def grow_apart(blocks: DataFrame, boosters: list[Booster], bin_counts: list[int], seconds: float | None = None) -> None:
    """One task a model, those with most work first. With a time limit every model has the same share of it."""
    sc = blocks.sparkSession.sparkContext
    if seconds is not None:
        seconds *= min(1.0, sc.defaultParallelism / len(boosters))
    first = sorted(boosters, key=lambda b: (-work_of(b.params), b.model))
    fresh = {b.model: (b.params, b.init, b.features) for b in boosters}

    def work(pairs):
        rows: list = []
        model = None
        for model, row in pairs:
            rows.append(tuple(row))
        if model is None:
            return
        c = joined(sorted(rows))
        rows.clear()
        b = Booster(model, *fresh[model])
        grow_model(b, c, bin_counts, seconds)
        kept = b.kept()
        trees = [tuple(vars(t).values()) for t in b.trees[:kept]]
        yield model, zlib.compress(pickle.dumps((trees, b.gains[:kept], b.history, b.lowest)), 1)

    # every task reads all blocks; they are few, and nothing is shuffled
    models = sc.parallelize([b.model for b in first], len(first))
    for model, state in models.cartesian(blocks.coalesce(1).rdd).mapPartitions(work).collect():
        b = boosters[model]
        trees, b.gains, b.history, b.lowest = pickle.loads(zlib.decompress(state))
        b.trees, b.done = [Tree(*t) for t in trees], True
