"""Manifest, history and ordering operators.

Ordered scans (row numbers, running minimum, contiguous folds) use ``running_scan``: split points of the
(group, order) keys are fixed first, the number of a row's part is a column made from them, each part runs a
local window, and a small table of per-(group, part) totals supplies the prefix from earlier parts. A group
holding a third of all rows is therefore spread over many tasks instead of one window partition.
Top-N per group uses ``row_number() <= N``, which Spark plans as a group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import cut_lineage
from .groups import join_groups

KEYS_PER_PART = 64
HASH_RANGE = 1 << 30


def with_part(df: DataFrame, keys: list[str], parts: int | None = None, name: str = "part") -> DataFrame:
    """``df`` with the part (0, 1, ...) of each row in ascending ``keys`` (NULLs first): a number that never falls as the
    keys rise and is the same whenever it is computed, since the split points are literals.

    There are at least ``parts`` parts (default: ``spark.sql.shuffle.partitions``), a power of two. The split points
    come from about ``KEYS_PER_PART`` keys a part, picked by a hash of the key; they decide how even the parts are,
    never what a scan returns. Keys that are equal share a part. The search among the points is one code-generated step
    per doubling of the parts."""
    wanted = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = 1 << max(1, (wanted - 1).bit_length())
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)])
    hashed = df.select(key.alias("key"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in keys]), F.lit(HASH_RANGE)).alias("h"))
    n = df.count()
    share = min(1.0, n_parts * KEYS_PER_PART / n) if n else 1.0
    some = hashed.where(F.col("h") < int(share * HASH_RANGE) + 1)
    # one array of about KEYS_PER_PART * n_parts keys, of which n_parts - 1 come back
    points = some.agg(F.sort_array(F.collect_list("key")).alias("keys")).where(F.size("keys") > 0).select(F.to_json(F.transform(
        F.sequence(F.lit(1), F.lit(n_parts - 1)),
        lambda i: F.element_at("keys", F.floor(i * F.size("keys") / n_parts).cast("int") + 1))).alias("p")).first()
    if points is None:
        return df.withColumn(name, F.lit(0))
    schema = hashed.schema["key"].dataType
    split = F.sort_array(F.from_json(F.lit(points["p"]), f"array<{schema.simpleString()}>"))  # folded to one literal
    # each step reads the column of the step before, so the steps stay projections of their own and do not multiply
    out, width = df.withColumn(name, F.lit(0)), n_parts >> 1
    while width:
        out = out.withColumn(name, F.when(F.element_at(split, F.col(name) + width) <= key, F.col(name) + width).otherwise(F.col(name)))
        width >>= 1
    return out


def running_scan(
    df: DataFrame,
    order: list[str],
    by: list[str] | tuple[str, ...] = (),
    min_of: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds ``_rn`` (1-based row number within ``by`` in ``order``) and, with ``min_of``, ``_run_min`` (minimum of
    ``min_of`` over rows before and including this one, NULLs skipped) and ``_min_before`` (the same without this
    one).

    ``order`` must be a total order within each group (add a unique tiebreaker), and ``df`` must hold the same rows
    whenever it is computed (write draws and made-up ids first). NULL groups and NULL keys are groups and keys like
    others, NULLs first; an empty table stays empty. The rows are shuffled once and never written."""
    by = list(by)
    # a struct is never NULL, so rows and totals meet by a plain equality on the key the window shuffled by
    at = F.struct(*[F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(by)], F.col("__part").alias("part"))
    r = with_part(df, by + list(order), partitions, "__part").withColumn("__at", at).drop("__part")
    upto = Window.partitionBy("__at").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("__at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = [F.count(F.lit(1)).over(upto).alias("__rn")]
    totals = [F.count(F.lit(1)).alias("__n")]
    if min_of:
        local += [F.min(min_of).over(upto).alias("__upto"), F.min(min_of).over(before).alias("__before")]
        totals.append(F.min(min_of).alias("__min"))
    # one row per (group, part): at most groups + parts rows, at most parts rows a group
    earlier = Window.partitionBy(*[f"__at.g{i}" for i in range(len(by))]).orderBy("__at.part").rowsBetween(Window.unboundedPreceding, -1)
    prefix = [F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off")]
    if min_of:
        prefix.append(F.min("__min").over(earlier).alias("__earlier"))
    stats = r.groupBy("__at").agg(*totals).select("__at", *prefix)
    out = r.select("*", *local).join(stats, "__at")
    cols = [F.col(f"`{c}`") for c in df.columns] + [(F.col("__off") + F.col("__rn")).alias("_rn")]
    if min_of:
        cols += [F.least("__earlier", "__upto").alias("_run_min"), F.least("__earlier", "__before").alias("_min_before")]
    return out.select(*cols)


def global_rank(df: DataFrame, order: list[str], by: list[str] | tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """0-based rank ``_rank`` of every row in ``order`` within ``by``; ties in arbitrary but fixed order. The rows are
    written once with the numbers that tell ties apart, so hand over the needed columns only."""
    x = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    ranked = running_scan(x, list(order) + ["_tie"], by, partitions=partitions)
    return ranked.withColumn("_rank", F.col("_rn") - 1).drop("_rn", "_tie")


def latest_entry(manifest: DataFrame, by: list[str] | tuple[str, ...] = ("stage",), ts: str = "ts",
                 tiebreak: str = "event_id") -> DataFrame:
    """Newest entry per group (or overall with ``by=()``) via ``max(struct(ts, tiebreak, ...))``:
    a partial aggregate, no window over a whole group."""
    by = list(by)
    rest = [c for c in manifest.columns if c not in by and c not in (ts, tiebreak)]
    latest = F.max(F.struct(F.col(ts), F.col(tiebreak), *[F.col(c) for c in rest])).alias("_m")
    g = manifest.groupBy(*by).agg(latest)
    return g.select(*by, *[F.col(f"_m.{c}").alias(c) for c in [ts, tiebreak] + rest])


def retention_plan(manifest: DataFrame, keep_n: int = C.MAX_CHECKPOINTS_TO_KEEP,
                   by: tuple[str, ...] = ("stage", "checkpoint_type"), ts: str = "ts", tiebreak: str = "event_id",
                   metric: str = "metric") -> DataFrame:
    """Every manifest row with ``keep`` (newest ``keep_n`` per group plus the best by the
    4-decimal metric, ties to the newest; nothing is deleted when a group has <= keep_n entries)."""
    by = list(by)
    m4 = F.round(F.col(metric), 4)
    newest = Window.partitionBy(*by).orderBy(F.col(ts).desc(), F.col(tiebreak).desc())
    best = Window.partitionBy(*by).orderBy(m4.asc_nulls_last(), F.col(ts).desc(), F.col(tiebreak).desc())
    keep_new = manifest.select(tiebreak, F.row_number().over(newest).alias("_rn")).where(F.col("_rn") <= keep_n)
    keep_best = (manifest.where(F.col(metric).isNotNull()).select(tiebreak, F.row_number().over(best).alias("_rb"))
                 .where(F.col("_rb") == 1))
    kept = keep_new.select(tiebreak).unionByName(keep_best.select(tiebreak)).distinct().withColumn("_k", F.lit(True))
    sizes = manifest.groupBy(*by).agg(F.count(F.lit(1)).alias("_gn"))
    out = join_groups(manifest.join(kept, tiebreak, "left"), sizes, by)
    keep = F.coalesce(F.col("_k"), F.lit(False)) | (F.col("_gn") <= keep_n)
    return out.select(*manifest.columns, keep.alias("keep"))


def manifest_listing(manifest: DataFrame, stage: str | None = None, ts: str = "ts", tiebreak: str = "event_id", position: str | None = None) -> DataFrame:
    """Entries newest first, optionally one stage (prefix test like ``name.startswith(stage + '_')``
    becomes an equality on the stage column). With ``position`` the entries are numbered by the
    partition-parallel scan instead of sorted for output."""
    m = manifest if stage is None else manifest.where(F.col("stage") == stage)
    if position is None:
        return m.orderBy(F.col(ts).desc(), F.col(tiebreak).desc())
    newest = m.withColumn("_nts", -F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_neid", -F.col(tiebreak))
    return running_scan(newest, ["_nts", "_neid"]).select(*manifest.columns, F.col("_rn").alias(position))


def best_so_far(history: DataFrame, by=("stage",), order=("ts", "event_id"), metric: str = "metric") -> DataFrame:
    """Running best before each step, best including it, and the strictly-better flag."""
    return _best_flags(history, list(by), list(order), metric)


def _best_flags(history: DataFrame, by: list[str], order: list[str], metric: str) -> DataFrame:
    """A row is a new best when its metric is below the minimum of all earlier rows of its group."""
    s = running_scan(history, order, by, min_of=metric)
    best_before = F.col("_min_before")
    is_new = F.col(metric).isNotNull() & (best_before.isNull() | (F.col(metric) < best_before))
    return s.select(*history.columns, F.col("_rn").alias("step"), best_before.alias("best_before"),
                    F.col("_run_min").alias("best_so_far"), is_new.alias("is_new_best"))


def best_step(history: DataFrame, by=("stage",), step: str = "event_id", metric: str = "metric") -> DataFrame:
    """First step with the minimum metric: ``min(struct(metric, step))`` (partial aggregate)."""
    by = list(by)
    b = F.min(F.when(F.col(metric).isNotNull(), F.struct(F.col(metric).alias("m"), F.col(step).alias("s"))))
    return history.groupBy(*by).agg(b.alias("_b")).select(
        *by, F.col("_b.s").alias("best_step"), F.col("_b.m").alias("best_metric"))


def early_stop(history: DataFrame, patience: int, by=("stage",), order=("ts", "event_id"), metric: str = "metric") -> DataFrame:
    """Per run, the step where training stops (first step that is ``patience`` steps after the
    last improvement) and the best step; runs that never stop report their last step."""
    by, order = list(by), list(order)
    narrow = history.select(*dict.fromkeys([*by, *order, metric]))
    flags = _best_flags(narrow, by, order, metric)
    # last improvement step at or before each step = running max of improving step numbers; two numbers a row are
    # written, so that the second scan does not repeat the first
    steps = cut_lineage(flags.select(*by, "step", F.when(F.col("is_new_best"), -F.col("step")).alias("_neg")))
    s2 = running_scan(steps, ["step"], by, min_of="_neg")
    s2 = s2.withColumn("_last_imp", -F.col("_run_min"))
    stop_rows = s2.where(F.col("_last_imp").isNotNull() & (F.col("step") - F.col("_last_imp") >= patience))
    stops = stop_rows.groupBy(*by).agg(F.min(F.struct("step", "_last_imp")).alias("_s"))
    lasts = s2.groupBy(*by).agg(F.max("step").alias("_last"),
                                F.max(F.struct(F.coalesce("_last_imp", F.lit(0)).alias("li"), "step")).alias("_lm"))
    out = join_groups(lasts, stops, by, "left")
    return out.select(
        *by,
        F.coalesce(F.col("_s.step"), F.col("_last")).alias("stop_step"),
        F.coalesce(F.col("_s._last_imp"), F.col("_lm.li")).alias("best_step"),
        F.col("_s.step").isNotNull().alias("stopped_early"),
    )


def batch_numbers(df: DataFrame, batch_size: int = C.DOWNLOAD_BATCH_SIZE, order: list[str] | None = None) -> DataFrame:
    """Row position ``row_idx`` (0-based, in ``order``) and ``batch = row_idx // batch_size``."""
    order = order or [df.columns[0]]
    s = running_scan(df, order)
    idx = F.col("_rn") - 1
    return s.select(*df.columns, idx.alias("row_idx"), F.floor(idx / batch_size).cast("long").alias("batch"))


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Deterministic bucket in [0, buckets) from md5 of (seed, key): stable under repartitioning and
    computable in SQL engines (first 7 hex digits as an integer)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.lit(":"), key.cast("string"))), 1, 7), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def shuffled_folds(df: DataFrame, key: str = "sample_id", k: int = C.N_FOLDS, seed: int = C.RANDOM_STATE) -> DataFrame:
    """W09 shuffled: fold by a seeded hash of the key (no shuffle, no order needed)."""
    return df.withColumn("fold", hash_bucket(F.col(key), seed, k).cast("int"))


def contiguous_folds(df: DataFrame, order: list[str], k: int = C.N_FOLDS) -> DataFrame:
    """W09 contiguous: ``ntile(k)`` over the order - the first n % k folds get one more row."""
    s = running_scan(df, order)
    n = df.count()
    size, big = n // k, n % k
    r = F.col("_rn") - 1
    fold = F.when(r < big * (size + 1), F.floor(r / (size + 1))).otherwise(
        F.lit(big) + F.floor((r - big * (size + 1)) / F.lit(max(size, 1))))
    return s.select(*df.columns, fold.cast("int").alias("fold"))


def decile_labels(df: DataFrame, value: str, n: int = 10, by=()) -> DataFrame:
    """Qcut label (0-based, distinct edges, right-closed) of a value."""
    from .quantiles import edges_list, percentile_edges

    by = list(by)
    probs = [i / n for i in range(1, n)]
    if not by:
        arr = F.array(*[F.lit(float(e)) for e in edges_list(df, value, probs)])
        x = df.withColumn("_edges", arr)
    else:
        x = join_groups(df, percentile_edges(df, value, probs, by).withColumnRenamed("edges", "_edges"), by)
    lab = F.size(F.filter(F.array_distinct("_edges"), lambda e: F.col(value) > e))
    # NULL and NaN have no label, as in a quantile cut
    return x.select(*df.columns, F.when(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")), lab).cast("int").alias("decile"))
