"""The long prediction table ``(model, split, sample_id, pred)`` and what is
computed from it - the wide stack of models, averages, normalised weights, weighted combinations,
and the weight search whose every objective evaluation is one distributed aggregate.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.errors import smape_term


def cache_for_iterations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep only ``cols`` and persist (memory, spilling to disk) for a driver loop that scans the table many times, in
    the partitions it comes in: none are merged, so no task's share grows with the table."""
    from pyspark import StorageLevel

    return df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)


def model_names(preds: DataFrame, model_col: str = "model") -> list[str]:
    """Sorted model names (bounded: one per model)."""
    return sorted(r[0] for r in preds.select(model_col).distinct().collect())


def stack_wide(preds: DataFrame, models: list[str] | None = None, key: str = "sample_id", model_col: str = "model",
               value: str = "pred", extra: tuple[str, ...] = ()) -> DataFrame:
    """One column per model in sorted order; ``complete`` is False when a model has no prediction for the key.

    One aggregate with a column per model: a key's rows become one before the shuffle where they come together (a pivot
    groups by key and model first, and then again)."""
    models = sorted(models or model_names(preds, model_col))
    g = preds.groupBy(key, *extra).agg(*[F.first(F.when(F.col(model_col) == m, F.col(value)), ignorenulls=True).alias(m) for m in models])
    complete = F.lit(True)
    for m in models:
        complete = complete & F.col(f"`{m}`").isNotNull()
    return g.withColumn("complete", complete)


def require_complete(wide: DataFrame) -> DataFrame:
    """The wide table without ``complete``; an error with the number of keys that lack a model's prediction, if any."""
    missing = wide.where(~F.col("complete")).count()
    if missing:
        raise ValueError(f"{missing} ids lack the prediction of at least one model")
    return wide.drop("complete")


def average_predictions(preds: DataFrame, key: str = "sample_id", value: str = "pred", by=()) -> DataFrame:
    """Mean over repeated predictions of the same key (passes, folds, models)."""
    return preds.groupBy(key, *by).agg(F.avg(value).alias("pred"), F.count(F.lit(1)).alias("n_preds"))


def normalise_weights(weights: DataFrame, weight_col: str = "raw_weight") -> DataFrame:
    """|w| / sum |w| over the (small) weight table."""
    return _normalise(weights, weight_col)


def _normalise(weights: DataFrame, weight_col: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy()  # the weight table has one row per model
    return weights.withColumn("weight", F.abs(F.col(weight_col)) / F.sum(F.abs(F.col(weight_col))).over(w))


def inverse_smape_weights(preds: DataFrame, t: str = "y_true", p: str = "pred", model_col: str = "model") -> DataFrame:
    """Raw weight per model = 1 / SMAPE, then A22 normalisation."""
    s = preds.groupBy(model_col).agg((100.0 * F.avg(smape_term(F.col(t), F.col(p)))).alias("smape"))
    return _normalise(s.withColumn("raw_weight", 1.0 / F.col("smape")), "raw_weight")


MAX_BROADCAST_MODELS = 10_000


def weighted_combination(preds: DataFrame, weights: DataFrame, key: str = "sample_id", model_col: str = "model",
                         value: str = "pred", extra: tuple[str, ...] = ()) -> DataFrame:
    """Sum over models of weight * prediction. The weight table has one row per model; it is
    broadcast after checking that size (a plain join beyond it)."""
    w = weights.select(model_col, "weight")
    small = w.limit(MAX_BROADCAST_MODELS + 1).count() <= MAX_BROADCAST_MODELS
    j = preds.join(F.broadcast(w) if small else w, model_col)
    return j.groupBy(key, *extra).agg(F.sum(F.col("weight") * F.col(value)).alias("pred"))


def weighted_expr(models: list[str], weights) -> F.Column:
    return sum(F.col(f"`{m}`") * float(w) for m, w in zip(models, weights))


PASS_ROWS = 1 << 16  # rows that a task scores, at least, where there are as many


class PackedRows:
    """The target and the predictions of the rows that have all of them, packed once, a batch after the other, and kept
    (memory, spilling to disk) for passes that are one job each without SQL planning. A pass has no more tasks than
    there are ``PASS_ROWS`` rows: few rows in many partitions are read by few tasks. ``close`` lets the rows go."""

    def __init__(self, wide: DataFrame, models: list[str], target: str):
        from pyspark import StorageLevel

        def pack(batches):
            import pyarrow as pa

            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["x"])

        x = wide.select(F.col(f"`{target}`").cast("double").alias("t"), *[F.col(f"`{m}`").cast("double").alias(f"m{i}") for i, m in enumerate(models)])
        x = x.where(" and ".join(f"{c} is not null" for c in x.columns))
        self.kept = x.mapInArrow(pack, "x binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
        row = 8 * (len(models) + 1)
        sizes = self.kept.mapPartitions(lambda batches: [sum(map(len, batches)) // row]).collect()  # a number a partition
        self.rows = self.kept.coalesce(min(len(sizes), -(-max(sum(sizes), 1) // PASS_ROWS))) if sizes else self.kept

    def close(self) -> None:
        self.kept.unpersist()


def smape_of_weights(wide: DataFrame | PackedRows, models: list[str], target: str, candidates: list[np.ndarray]) -> list[float]:
    """SMAPE of several candidate weight vectors (|w| / sum |w|) in ONE pass over the rows (no cross join).

    The candidates go along as data: a task multiplies its batches with the matrix of weights, and the driver adds up
    one row of sums a task, in their order. Rows with a NULL target or prediction count for no candidate. Who asks
    many times hands over the rows packed."""
    w = np.abs(np.array([np.asarray(c, dtype=float) for c in candidates]))
    total = w.sum(axis=1, keepdims=True)
    w = np.where(total > 0, w / np.where(total > 0, total, 1.0), 1.0 / len(models))
    columns = len(models) + 1

    def sums(batches):
        n, s = 0, np.zeros(len(w))
        for raw in batches:
            x = np.frombuffer(raw).reshape(columns, -1)
            t, pred = x[:1], w @ x[1:]
            n += x.shape[1]
            s += (np.abs(pred - t) / ((np.abs(t) + np.abs(pred)) / 2.0 + 1e-10)).sum(axis=1)
        yield n, s.tolist()

    packed = wide if isinstance(wide, PackedRows) else PackedRows(wide, models, target)
    try:
        found = packed.rows.mapPartitions(sums).collect()
    finally:
        if packed is not wide:
            packed.close()
    n = sum(n for n, _ in found)
    if not n:
        raise ValueError("no row has the target and all predictions")
    return [100.0 * v / n for v in np.sum([s for _, s in found], axis=0).tolist()]


def _moves(simplex: list[np.ndarray]) -> list[np.ndarray]:
    """Reflection, expansion, outside and inside contraction of the last vertex. The centroid is summed in an order of the
    vertices' own, so that the same simplex always gives the same points."""
    worst = simplex[-1]
    centroid = np.mean(sorted(simplex[:-1], key=lambda v: tuple(v)), axis=0)
    d = centroid - worst
    return [centroid + d, centroid + 2.0 * d, centroid + 0.5 * d, centroid - 0.5 * d]


def _next_moves(simplex: list[np.ndarray]) -> list[np.ndarray]:
    """The moves of the step after this one, for whatever move is taken: the vertex that is worst then is the second
    worst of now or, after a contraction, the new one."""
    out = []
    for i, taken in enumerate(_moves(simplex)):
        out += _moves([*simplex[:-2], taken, simplex[-2]])
        if i >= 2:
            out += _moves([*simplex[:-1], taken])
    return out


def optimise_weights(wide: DataFrame, models: list[str], target: str, max_iter: int = 1000, tol: float = 1e-4) -> np.ndarray:
    """Nelder-Mead on the SMAPE of |w| / sum |w|, started at equal weights.

    The simplex lives on the driver (a handful of numbers). Every objective evaluation is a distributed sum; a
    job evaluates the n + 1 initial vertices, or the four candidates of a step together with those of the step after it,
    so that two steps cost one pass over the rows."""
    packed = PackedRows(wide, models, target)
    try:
        return _nelder_mead(packed, models, target, max_iter, tol)
    finally:
        packed.close()


def _nelder_mead(packed: PackedRows, models: list[str], target: str, max_iter: int, tol: float) -> np.ndarray:
    n = len(models)
    known: dict[bytes, float] = {}

    def score(points: list[np.ndarray], ahead: list[np.ndarray] = ()) -> list[float]:
        if any(p.tobytes() not in known for p in points):
            new = list({p.tobytes(): p for p in [*points, *ahead] if p.tobytes() not in known}.values())
            known.update(zip((p.tobytes() for p in new), smape_of_weights(packed, models, target, new)))
        return [known[p.tobytes()] for p in points]

    x0 = np.full(n, 1.0 / n)
    simplex = [x0] + [x0 * (1 + 0.05 * np.eye(n)[i]) for i in range(n)]  # scipy's default initial simplex
    fs = score(simplex)
    for _ in range(max_iter):
        order = np.argsort(fs, kind="stable")
        simplex = [simplex[i] for i in order]
        fs = [fs[i] for i in order]
        if max(abs(f - fs[0]) for f in fs) <= tol and max(np.max(np.abs(s - simplex[0])) for s in simplex) <= tol:
            break
        xr, xe, xc, xcc = moves = _moves(simplex)
        fr, fe, fc, fcc = score(moves, _next_moves(simplex))
        if fr < fs[0]:
            simplex[-1], fs[-1] = (xe, fe) if fe < fr else (xr, fr)
        elif fr < fs[-2]:
            simplex[-1], fs[-1] = xr, fr
        elif fr < fs[-1] and fc <= fr:
            simplex[-1], fs[-1] = xc, fc
        elif fr >= fs[-1] and fcc < fs[-1]:
            simplex[-1], fs[-1] = xcc, fcc
        else:  # shrink towards the best vertex
            simplex = [simplex[0]] + [simplex[0] + 0.5 * (s - simplex[0]) for s in simplex[1:]]
            fs = score(simplex)
    best = simplex[int(np.argmin(fs))]
    w = np.abs(best)
    return w / w.sum()


def _lattice(n: int, steps: int) -> list[np.ndarray]:
    """All points of the probability simplex with coordinates in multiples of 1/steps."""
    out = []

    def rec(prefix, left, k):
        if k == 1:
            out.append(np.array(prefix + [left], dtype=float) / steps)
            return
        for i in range(left + 1):
            rec(prefix + [i], left - i, k - 1)

    rec([], steps, n)
    return out


def pattern_search_weights(wide: DataFrame, models: list[str], target: str, steps: int = 6, rounds: int = 12,
                           tol: float = 1e-4) -> np.ndarray:
    """K14 alternative with few jobs: one pass scores a simplex lattice (C(steps+n-1, n-1) points);
    then each round scores, in one pass, every move of mass ``d`` from one model to another around
    the incumbent and halves ``d`` when nothing improves. About ``rounds`` + 1 jobs in total, each over
    the whole table (no sampling)."""
    packed = PackedRows(wide, models, target)
    try:
        return _pattern_search(packed, models, target, steps, rounds, tol)
    finally:
        packed.close()


def _pattern_search(packed: PackedRows, models: list[str], target: str, steps: int, rounds: int, tol: float) -> np.ndarray:
    n = len(models)
    cands = _lattice(n, steps)
    scores = smape_of_weights(packed, models, target, cands)
    best_i = int(np.argmin(scores))
    best, best_s = cands[best_i], scores[best_i]
    d = 1.0 / steps / 2
    for _ in range(rounds):
        moves = []
        for i in range(n):
            for j in range(n):
                if i != j and best[j] > 0:
                    step = min(d, best[j])
                    w = best.copy()
                    w[i] += step
                    w[j] -= step
                    moves.append(w)
        if not moves:
            break
        s = smape_of_weights(packed, models, target, moves)
        k = int(np.argmin(s))
        if s[k] < best_s - tol * 1e-3:
            best, best_s = moves[k], s[k]
        else:
            d /= 2
            if d < tol:
                break
    return best / best.sum()
