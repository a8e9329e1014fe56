"""A suffix array by induced sorting, in numpy: one task's shard of text.

Suffixes are classified (S: smaller than the next, L: larger). The substrings between leftmost S-positions
are sorted and named; the string of names is sorted by recursive pairing of names; the order of those
suffixes then induces that of all L- and of all S-suffixes, one bucket (first symbol) at a time, each bucket
as array operations. Order is exact on the first ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np

PER_KEY = 6  # symbols with their type (10 bits each) in one sorting key


def _ranks(key: np.ndarray) -> np.ndarray:
    """Dense rank of each value."""
    order = np.argsort(key)
    new = np.ones(len(key), dtype=np.int64)
    new[1:] = key[order[1:]] != key[order[:-1]]
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _sorted_starts(text: np.ndarray, small: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The leftmost S-positions, sorted by their suffixes."""
    n, m = len(text), len(starts)
    stop = np.append(starts[1:] + 1, n)  # a substring includes the first symbol of the next
    symbol = np.zeros(n + PER_KEY, dtype=np.int64)
    symbol[:n] = text.astype(np.int64) * 2 + small + 1
    name = np.zeros(m, dtype=np.int64)
    open_, shift = np.arange(m), 0
    while len(open_):  # names by six symbols at a time, for the substrings that are longer
        at = starts[open_] + shift
        key = np.zeros(len(open_), dtype=np.int64)
        for k in range(PER_KEY):
            key = (key << 10) | np.where(at + k < stop[open_], symbol[np.minimum(at + k, n)], 0)
        whole = np.zeros(m, dtype=np.int64)
        whole[open_] = _ranks(key) + 1
        name = _ranks(name * (int(whole.max()) + 1) + whole)
        shift += PER_KEY
        open_ = open_[starts[open_] + shift < stop[open_]]
        if shift > depth:
            break
    step = 1
    while step * 2 <= max(depth, 2) and m > 1 and int(name.max()) + 1 < m:  # 2 symbols a name at least
        after = np.zeros(m, dtype=np.int64)
        after[:-step] = name[step:] + 1
        name = _ranks(name * (m + 2) + after)
        step *= 2
    return starts[np.argsort(name)]


def _push(lists: list[list[np.ndarray]], text: np.ndarray, at: np.ndarray) -> None:
    """Append positions to the lists of their symbols, in order."""
    if len(at):
        order = np.argsort(text[at].astype(np.int16), kind="stable")
        at = at[order]
        cut = np.flatnonzero(np.diff(text[at])) + 1
        for part in np.split(at, cut):
            lists[text[part[0]]].append(part)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (small non-negative integers) sorted by the ``depth`` symbols from there."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    text = text.astype(np.int64)
    rises = np.append(np.sign(np.diff(text)), -1)  # the end is smaller than every symbol
    differs = np.flatnonzero(rises)
    small = rises[differs[np.searchsorted(differs, np.arange(n))]] > 0
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = _sorted_starts(text, small.astype(np.int64), starts, depth) if len(starts) else starts
    size = int(text.max()) + 1
    empty = np.zeros(0, dtype=np.int64)

    seeded: list[list[np.ndarray]] = [[] for _ in range(size)]
    _push(seeded, text, seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    larger[text[n - 1]].append(np.array([n - 1]))
    section = []
    for c in range(size):
        wave = np.concatenate(larger[c]) if larger[c] else empty
        waves = [wave]
        while len(wave):  # L-suffixes of the same symbol, one run length after another
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & ~small[before]]
            waves.append(wave)
        mine = np.concatenate(waves)
        section.append(mine)
        scanned = np.concatenate([mine, *seeded[c]])
        before = scanned[scanned > 0] - 1
        _push(larger, text, before[~small[before] & (text[before] > c)])

    smaller: list[list[np.ndarray]] = [[] for _ in range(size)]
    out = [empty] * size
    for c in range(size - 1, -1, -1):
        wave = np.concatenate(smaller[c]) if smaller[c] else empty
        waves = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & small[before]]
            waves.append(wave)
        mine = np.concatenate(waves)  # from the largest down
        out[c] = np.concatenate([section[c], mine[::-1]])
        scanned = out[c][::-1]
        before = scanned[scanned > 0] - 1
        _push(smaller, text, before[small[before] & (text[before] < c)])
    return np.concatenate(out)


def same_prefix(raw: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` (at least 8) bytes from a and from b agree, all inside ``raw``."""
    words = np.lib.stride_tricks.as_strided(raw.view(np.uint8), (len(raw) - 7, 8), (1, 1))
    same = np.ones(len(a), dtype=bool)
    for k in [*range(0, length - 8, 8), length - 8]:
        same &= (words[a + k].view(np.uint64) == words[b + k].view(np.uint64)).ravel()
    return same
