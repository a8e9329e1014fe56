"""Joining back what was computed per group, without losing groups whose key is NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_GROUPS = 10_000


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` where NULL keys match NULL keys, as they do in ``groupBy``.
    The keys come from ``left``. ``<=>`` is an equi-join for Spark: it is hashed or broadcast as usual."""
    keys = list(keys)
    if not keys:
        return left.join(right, [], how)
    names = {k: f"__group_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[n]) for k, n in names.items()])
    return left.join(right, same, how).drop(*names.values())


def beside_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``join_groups`` for a ``left`` of many rows a group and a ``right`` of one row a group, written before or else
    cheap to make. Up to ``MAX_BROADCAST_GROUPS`` groups are counted and broadcast, so that the rows stay where they are;
    dealt out by group, a few groups would take all rows to as many tasks (Spark itself gives broadcasting up where most
    partitions are empty)."""
    few = right.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS
    return join_groups(left, F.broadcast(right) if few else right, keys, how)
