"""Column profiling and the feature audit, each in one or two scans.

Wide checks are single aggregates with one expression per column (no per-column jobs); quantiles
use the skew-safe exact operator on the unpivoted (column, value) table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType

from ..session import cut_lineage
from .quantiles import exact_percentiles

META_COLUMNS = ("sample_id", "catalog_content", "image_link", "price", "potential_brand", "ipq_unit", "ipq_unit_type")


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans are not numeric, as in pandas)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def feature_columns(df: DataFrame, exclude=META_COLUMNS) -> list[str]:
    """Every column but ids, texts, targets and string-valued features (defect D7 fixed)."""
    return [c for c in df.columns if c not in exclude]


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def missing_expr(df: DataFrame, c: str):
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _is_float(df, c) else col.isNull()


def fill_missing(df: DataFrame, value: float = 0.0, cols: list[str] | None = None) -> DataFrame:
    """NULL and NaN -> value in numeric columns (``na.fill`` fills both for doubles)."""
    cols = cols or numeric_columns(df)
    return df.na.fill(value, subset=cols)


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column and in total, one aggregate. Long form (column, n_missing)."""
    aggs = [F.sum(missing_expr(df, c).cast("long")).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias("n_missing"))
                                          for c in df.columns])).alias("s")).select("s.column", "s.n_missing")


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with at most one distinct non-missing value, via min = max per column (one pass,
    no distinct-count expansion). Long form (column, n_present, is_constant)."""
    parts = []
    for c in df.columns:
        v = F.when(~missing_expr(df, c), F.col(c))
        parts += [F.min(v).cast("string").alias(f"{c}__min"), F.max(v).cast("string").alias(f"{c}__max"),
                  F.count(v).alias(f"{c}__n")]
    wide = df.agg(*parts)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}__n`").alias("n_present"),
                     ((F.col(f"`{c}__n`") == 0) | (F.col(f"`{c}__min`") == F.col(f"`{c}__max`"))).alias("is_constant"))
            for c in df.columns]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


COLUMNS_PER_JOB = 40


def column_checks(df: DataFrame) -> DataFrame:
    """A13 + A14: (column, n_missing, n_present, is_constant) per column - one aggregate per chunk of
    columns (one pass for ordinary tables), materialised (one row per column)."""
    rows = []
    for i in range(0, len(df.columns), COLUMNS_PER_JOB):
        chunk = df.columns[i:i + COLUMNS_PER_JOB]
        parts = []
        for c in chunk:
            v = F.when(~missing_expr(df, c), F.col(c))
            parts += [F.sum(missing_expr(df, c).cast("long")).alias(f"{c}__miss"), F.min(v).cast("string").alias(f"{c}__min"),
                      F.max(v).cast("string").alias(f"{c}__max"), F.count(v).alias(f"{c}__n")]
        r = df.agg(*parts).collect()[0]
        rows += [(c, int(r[f"{c}__miss"] or 0), int(r[f"{c}__n"]), r[f"{c}__n"] == 0 or r[f"{c}__min"] == r[f"{c}__max"])
                 for c in chunk]
    return df.sparkSession.createDataFrame(rows, "column string, n_missing long, n_present long, is_constant boolean")


def masked_gram_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sums over the rows where both columns i < j of a pair are present: (i, j, n, si, sj, sii, sjj, sij), one row a
    pair. Each task adds up matrix products of its batches (values with 0 for missing, and the mask of what is
    present), so a task sends one row a pair, however many rows it reads. Values are taken less the column's mean,
    which keeps the differences of large sums exact enough."""
    d = len(cols)
    x = df.select(*[F.when(~missing_expr(df, c), F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]).persist()  # read twice, and may be dear to make
    means = x.agg(*[F.coalesce(F.avg(f"c{i}"), F.lit(0.0)).alias(f"c{i}") for i in range(d)]).first()
    shift = [float(means[f"c{i}"]) for i in range(d)]

    def sums(batches):
        import numpy as np
        import pandas as pd

        total = np.zeros((4, d, d))
        for pdf in batches:
            v = pdf.to_numpy(dtype="float64", na_value=np.nan)
            there = ~np.isnan(v)
            v = np.where(there, v - np.asarray(shift), 0.0)
            m = there.astype("float64")
            total += [m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v]
        n, s, q, p = total
        i, j = np.triu_indices(d, 1)
        yield pd.DataFrame({"i": i, "j": j, "n": n[i, j], "si": s[i, j], "sj": s[j, i], "sii": q[i, j], "sjj": q[j, i], "sij": p[i, j]})

    parts = x.mapInPandas(sums, "i int, j int, n double, si double, sj double, sii double, sjj double, sij double")
    try:
        return cut_lineage(parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")]))  # a row a pair
    finally:
        x.unpersist()


# a sum of squares about the mean that is below this share of the sum of squares is rounding: the column is constant
CONSTANT_SHARE = 1e-13


def high_correlations(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.95) -> DataFrame:
    """Pairs (upper triangle, column order) with |pearson r| > threshold, pairwise-complete: r is taken over the
    rows where both columns are present. A pair with a column that is constant there, or without such rows, has no r.
    One aggregate for the means, one pass of matrix products (``masked_gram_sums``), for gappy columns and others
    alike; infinite values have no r either."""
    cols = cols or numeric_columns(df)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    names = F.array(*[F.lit(c) for c in cols])
    dev = lambda q, s: F.when(F.col(q) - F.col(s) * F.col(s) / F.col("n") > F.col(q) * CONSTANT_SHARE,
                              F.col(q) - F.col(s) * F.col(s) / F.col("n"))
    r = F.try_divide(F.col("sij") - F.col("si") * F.col("sj") / F.col("n"), F.sqrt(dev("sii", "si")) * F.sqrt(dev("sjj", "sj")))
    out = masked_gram_sums(df, cols).where("n > 0").select(
        F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"), r.alias("corr"))
    return out.where((F.abs("corr") > threshold) & ~F.isnan("corr"))


def pairwise_corr(a: str, b: str):
    """Pearson r over rows where both are present; NULL (not an error) for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    xa, xb = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb))


def unpivot_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, value DOUBLE) for every non-missing numeric cell."""
    cols = cols or numeric_columns(df)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = x.unpivot([], cols, "column", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per numeric column (long form)."""
    long = unpivot_numeric(df, cols)
    basic = long.groupBy("column").agg(F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                       F.max("value").alias("max"))
    q = exact_percentiles(long, "value", [0.25, 0.5, 0.75], by=["column"])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p_idx") == i, F.col("value"))).alias(n)
                                   for i, n in enumerate(["q25", "q50", "q75"])])
    return basic.join(qw, "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_ranges(desc: DataFrame) -> DataFrame:
    """A16 second half: range of the column means and of the column deviations."""
    return desc.agg(F.min("mean").alias("mean_min"), F.max("mean").alias("mean_max"),
                    F.min("std").alias("std_min"), F.max("std").alias("std_max"))


def column_groups(df: DataFrame) -> DataFrame:
    """Feature columns counted by prefix (ipq_, text_, has_, tfidf_, other). Schema-level."""
    def group(c):
        for p in ("ipq_", "text_", "has_", "tfidf_"):
            if c.startswith(p):
                return p.rstrip("_")
        return "other"

    counts: dict[str, int] = {}
    for c in df.columns:
        counts[group(c)] = counts.get(group(c), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "column_group string, n_columns long")


def column_alignment(train: DataFrame, test: DataFrame, ignore=("price",)) -> DataFrame:
    """Columns present on one side only. Schema-level."""
    a = set(train.columns) - set(ignore)
    b = set(test.columns) - set(ignore)
    rows = [("missing_in_test", c) for c in sorted(a - b)] + [("missing_in_train", c) for c in sorted(b - a)]
    return train.sparkSession.createDataFrame(rows, "issue string, column string")


def dataset_profile(df: DataFrame, split_col: str = "split", price: str = "price") -> DataFrame:
    """Q04: rows, columns, price range and mean per split."""
    ok = ~(F.col(price).isNull() | F.isnan(price))
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns) - 1).cast("long").alias("n_columns"),
        F.min(F.when(ok, F.col(price))).alias("price_min"), F.max(F.when(ok, F.col(price))).alias("price_max"),
        F.avg(F.when(ok, F.col(price))).alias("price_mean"))


def column_moments(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mean and sample deviation per numeric column, one aggregate over the rows as they are. Long form."""
    cols = cols or numeric_columns(df)
    present = {c: F.when(~missing_expr(df, c), F.col(f"`{c}`").cast("double")) for c in cols}
    wide = df.agg(*[f(v).alias(f"{c}__{n}") for c, v in present.items() for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}__mean`").alias("mean"), F.col(f"`{c}__std`").alias("std")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def feature_audit(features: DataFrame, numeric: list[str] | None = None, threshold: float = 0.95) -> DataFrame:
    """Q05: one report table (check, item, value) - missing values, constant columns, highly
    correlated pairs, and the ranges of column means and deviations. The input is persisted for the
    checks and the report (columns and column pairs) is returned materialised."""
    features = features.persist()
    checks = column_checks(features)  # missing counts and constant flags in one pass
    total = checks.agg(F.sum("n_missing").cast("double").alias("value")).select(
        F.lit("missing_values").alias("check"), F.lit("total").alias("item"), "value")
    const = checks.where("is_constant").select(
        F.lit("constant_column").alias("check"), F.col("column").alias("item"), F.lit(1.0).alias("value"))
    corr = high_correlations(features, numeric, threshold).where(F.col("corr").isNotNull() & ~F.isnan("corr")).select(
        F.lit("high_correlation").alias("check"), F.concat_ws("~", "col_a", "col_b").alias("item"), F.col("corr").alias("value"))
    rng = describe_ranges(column_moments(features, numeric))
    ranges = rng.select(F.explode(F.array(*[F.struct(F.lit(n).alias("item"), F.col(n).alias("value"))
                                            for n in ["mean_min", "mean_max", "std_min", "std_max"]])).alias("s")).select(
        F.lit("describe_range").alias("check"), "s.item", "s.value")
    rep = reduce(DataFrame.unionByName, [total, const, corr, ranges])
    out = features.sparkSession.createDataFrame(rep.collect(), rep.schema)
    features.unpersist()
    return out
