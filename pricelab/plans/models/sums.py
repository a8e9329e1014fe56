"""Sums of rows' values in every bin of every column.

Columns are counted together as long as their bins multiply to few cells: the counts of each are sums over the others.
"""

from __future__ import annotations

import math

import numpy as np

CELLS = 1 << 12  # joint bins of columns that are counted together
FEW = 2000  # rows up to which all columns are counted at once


def together(sizes: list[int], most: int = CELLS) -> list[list[int]]:
    """Columns in groups whose bins multiply to at most ``most`` (or a column alone)."""
    cells: list[int] = []
    groups: list[list[int]] = []
    for c in sorted(range(len(sizes)), key=lambda c: (-sizes[c], c)):
        at = next((i for i, n in enumerate(cells) if n * sizes[c] <= most), len(cells))
        if at == len(cells):
            cells.append(1)
            groups.append([])
        cells[at] *= sizes[c]
        groups[at].append(c)
    return groups


class Binned:
    """Rows by column, and the sums of values of theirs in each bin."""

    def __init__(self, bins: np.ndarray, sizes: list[int], width: int):
        self.bins, self.width = bins, width
        self.first = np.arange(len(sizes), dtype=np.intp)[:, None] * width
        self.groups = []
        for columns in together(sizes):
            cells = math.prod(sizes[c] for c in columns)
            key = bins[columns[0]].astype(np.uint8 if cells <= 1 << 8 else np.uint16 if cells <= 1 << 16 else np.intp)
            for c in columns[1:]:
                key *= key.dtype.type(sizes[c])
                key += bins[c]
            self.groups.append((columns, [sizes[c] for c in columns], key))

    def sums(self, rows: np.ndarray | slice, values: list[np.ndarray | None]) -> np.ndarray:
        """(values, columns, bins) over ``rows``; a value that is None is 1 in every row."""
        columns, some = len(self.first), not isinstance(rows, slice)
        out = np.zeros((len(values), columns, self.width))
        values = [v if v is None else v.take(rows) if some else v[rows] for v in values]
        bins = self.bins if some else self.bins[:, rows]
        if (len(rows) if some else bins.shape[1]) < FEW:
            key = ((bins.take(rows, axis=1) if some else bins) + self.first).ravel()
            for k, v in enumerate(values):
                out[k] = np.bincount(key, None if v is None else np.tile(v, columns), out[k].size).reshape(out[k].shape)
            return out
        for members, sizes, key in self.groups:
            key = (key.take(rows) if some else key[rows]).astype(np.intp)
            for k, v in enumerate(values):
                cube = np.bincount(key, v, math.prod(sizes)).reshape(sizes)
                for axis, c in enumerate(members):
                    out[k, c, : sizes[axis]] = cube.sum(axis=tuple(a for a in range(len(sizes)) if a != axis))
        return out
