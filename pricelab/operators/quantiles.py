"""Exact percentiles (numpy 'linear' rule) by selection: no sort, no list of distinct values, no window over rows.

Spark's exact ``percentile`` keeps a value->count map of the whole group inside one aggregation buffer; for a hot
group that is one task holding everything. Here the interval that holds a needed rank is cut into ``BUCKETS``
parts, one partial aggregate counts the rows of every part with their smallest and largest value, and the parts
that hold the rank are the next intervals. Rows outside of these drop out before the next aggregate. A part whose
smallest and largest value are equal is the answer, however many rows have it. An interval's ends fall into
different parts, so every pass splits; with B parts, n values take about log(n) / log(B) of them.

Per group a pass keeps at most 2 x len(probs) intervals, in an array that joins the group's rows (one row a
group). It is the same path for one group and for any number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .groups import beside_groups, join_groups

BUCKETS = 1 << 16


def _finite(c):
    return c.isNotNull() & ~F.isnan(c)


def count_at_most(value, split, n: int):
    """Number of the ``n`` ascending split points ``split(i)`` that are <= ``value``, as a balanced tree of
    CASE expressions: log2(n) code-generated comparisons per row (a ``filter`` lambda over the array
    would be interpreted and touch every split)."""

    def rec(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2  # is the count above mid?  <=> split(mid) <= value
        return F.when(split(mid) <= value, rec(mid + 1, hi)).otherwise(rec(lo, mid))

    return rec(0, n)


def _lerp(lo, hi, t):
    """numpy's interpolation: a + (b-a)t for t < 0.5, b - (b-a)(1-t) otherwise."""
    d = hi - lo
    return F.when(t >= 0.5, hi - d * (1 - t)).otherwise(lo + d * t)


def _scaled(v: Column) -> Column:
    """A non-decreasing scale on which values of very different size lie apart."""
    return F.signum(v) * F.log1p(F.abs(v))


def _part(v: Column, lo: Column, hi: Column) -> Column:
    """The part of [lo, hi] that v is in; never falls as v rises. Where an end is infinite, all between the ends
    is one part."""
    share = (_scaled(v) - _scaled(lo)) / (_scaled(hi) - _scaled(lo))
    inner = F.when(F.isnan(share), F.lit(BUCKETS // 2)).otherwise(F.least(F.floor(share * BUCKETS).cast("int"), F.lit(BUCKETS - 1)))
    return F.when(v <= lo, F.lit(0)).when(v >= hi, F.lit(BUCKETS - 1)).otherwise(inner)


def _beside_intervals(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Each row with its group's intervals; without groups there is one array, a literal."""
    if by:
        return beside_groups(rows, state.select(*by, "_in"), by)
    held = state.select("_in").first()
    point = lambda s: F.struct(F.lit(s["lo"]).alias("lo"), F.lit(s["hi"]).alias("hi"), F.lit(s["off"]).alias("off"))
    return rows.withColumn("_in", F.array(*[point(s) for s in held["_in"]]))


def exact_percentiles(df: DataFrame, value: str, probs: list[float], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Long table ``(by..., p_idx INT, p DOUBLE, value DOUBLE)``; NULL/NaN values are ignored, groups without any
    other value are left out."""
    by = list(by)
    base = df.select(*[F.col(b) for b in by], F.col(value).cast("double").alias("_v")).where(_finite(F.col("_v"))).persist()
    try:
        # what a pass finds is written: a cached frame would show the plans of all passes before it, twice each
        stats = cut_lineage(base.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).where("_n > 0"))
        need = stats.select(*by, "_n", F.explode(F.array(*[F.struct(F.lit(i).alias("p_idx"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])).alias("_p"))
        need = need.select(*by, "_n", "_p.p_idx", "_p.p", ((F.col("_n") - 1) * F.col("_p.p")).alias("_h"))
        need = need.select(*by, "p_idx", "p", F.floor("_h").cast("long").alias("lo"), F.least(F.floor("_h").cast("long") + 1, F.col("_n") - 1).alias("hi"),
                           (F.col("_h") - F.floor("_h")).alias("t"))
        wanted = need.groupBy(*by).agg(F.array_distinct(F.flatten(F.collect_list(F.array("lo", "hi")))).alias("_r"))  # 2 x len(probs) at most
        live = (join_groups(stats, wanted, by) if by else stats.withColumn("_r", F.lit((wanted.first() or [[]])[0]).cast("array<bigint>")))
        live = live.select(*by, F.array(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.lit(0).cast("long").alias("off"), F.col("_r").alias("ranks"))).alias("_in"))
        found: list[DataFrame] = []
        while not live.isEmpty():
            v = F.col("_v")
            met = _beside_intervals(base, live, by)
            if found:  # most rows are outside of all intervals; those between the first and the last are looked up
                met = met.where((F.col("_v") >= F.array_min("_in")["lo"]) & (F.col("_v") <= F.array_max("_in")["hi"]))
                inside = F.filter("_in", lambda s: (s["lo"] <= F.col("_v")) & (F.col("_v") <= s["hi"]))
                met = met.withColumn("_s", F.get(inside, F.lit(0))).where("_s is not null")
            else:
                met = met.withColumn("_s", F.get("_in", F.lit(0)))  # the whole group
            met = met.select(*by, "_v", F.col("_s.off").alias("_off"), _part(v, F.col("_s.lo"), F.col("_s.hi")).alias("_b"))
            parts = met.groupBy(*by, "_off", "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            before = Window.partitionBy(*by, "_off").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows each
            parts = parts.withColumn("_at", F.col("_off") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
            asked = live.select(*by, F.explode("_in").alias("_s")).select(*by, F.col("_s.off").alias("_off"), F.col("_s.ranks").alias("_r"))
            parts = join_groups(parts, asked, [*by, "_off"])
            parts = parts.withColumn("_r", F.filter("_r", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_c")))).where(F.size("_r") > 0)
            picked = cut_lineage(parts.select(*by, "_lo", "_hi", "_at", "_r"))
            found.append(picked.where("_lo = _hi").select(*by, F.explode("_r").alias("_rank"), F.col("_lo").alias("_value")))
            point = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_at").alias("off"), F.col("_r").alias("ranks"))
            live = picked.where("_lo < _hi").groupBy(*by).agg(F.collect_list(point).alias("_in")).where(F.size("_in") > 0)
        if not found:
            return stats.where("1 = 0").select(*by, F.lit(0).alias("p_idx"), F.lit(0.0).alias("p"), F.lit(0.0).alias("value"))
        at = reduce(DataFrame.unionByName, found)
        low = join_groups(need, at.select(*by, F.col("_rank").alias("lo"), F.col("_value").alias("_vlo")), [*by, "lo"])
        both = join_groups(low, at.select(*by, F.col("_rank").alias("hi"), F.col("_value").alias("_vhi")), [*by, "hi"])
        return cut_lineage(both.select(*by, "p_idx", "p", _lerp(F.col("_vlo"), F.col("_vhi"), F.col("t")).alias("value")))
    finally:
        base.unpersist()  # the result is written


def percentile_edges(df: DataFrame, value: str, probs: list[float], by=(), approx: bool = False) -> DataFrame:
    """Edges as one array column per group: ``(by..., edges ARRAY<DOUBLE>)`` ordered by p."""
    by = list(by)
    if approx:
        return df.groupBy(*by).agg(F.percentile_approx(F.col(value).cast("double"), probs, 10000).cast("array<double>").alias("edges"))
    long = exact_percentiles(df, value, probs, by)
    return long.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p_idx", "value"))), lambda s: s["value"]).alias("edges")
    )


def edges_list(df: DataFrame, value: str, probs: list[float], approx: bool = False) -> list[float]:
    """Ungrouped edges as a Python list (bounded: one number per probability)."""
    if approx:
        return [float(x) for x in df.approxQuantile(value, probs, 0.0001)]
    rows = exact_percentiles(df, value, probs).collect()
    return [r["value"] for r in sorted(rows, key=lambda r: r["p_idx"])]
