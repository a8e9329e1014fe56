"""Registered queries: profiling and audit (A13-A17, Q04, Q05, P04-P06, J01, J09) and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import splits as X
from ..oracle.fixtures import with_fixtures
from ..oracle.sqlfeatures import features_select
from ..plans.features import engineer_features
from ..registry import r6, register, rounded
from ..sources.derived import catalog

from .common import AUDIT_COLS, FLOAT_COLS, NUMERIC_COLS  # noqa: F401  (re-exported)


def _features(spark, sf_dir):
    return engineer_features(catalog(spark, sf_dir), keep=["price"])


FEATS_CTE = f", f as (select * from ({features_select('catalog', keep=('price',))}))\n"


def _miss(c: str) -> str:
    return f"({c} is null or isnan({c}))" if c in FLOAT_COLS else f"({c} is null)"


A13_SQL = FEATS_CTE + "\nunion all\n".join(
    f"select '{c}' as \"column\", cast(sum(case when {_miss(c)} then 1 else 0 end) as bigint) as n_missing from f" for c in AUDIT_COLS)


@register("a13_missing_counts", with_fixtures(A13_SQL))
def a13_missing_counts(spark, sf_dir):
    """Missing values per feature column (NULL or NaN), one aggregate."""
    return P.missing_counts(_features(spark, sf_dir))


def _present(c):
    return f"case when not {_miss(c)} then {c} end"


A14_SQL = FEATS_CTE + "\nunion all\n".join(
    f"select '{c}' as \"column\", count({_present(c)}) as n_present, "
    f"(count({_present(c)}) = 0 or min({_present(c)}) = max({_present(c)})) as is_constant from f" for c in AUDIT_COLS)


@register("a14_constant_columns", with_fixtures(A14_SQL))
def a14_constant_columns(spark, sf_dir):
    """Constant columns by min = max over present values (one pass)."""
    return P.constant_columns(_features(spark, sf_dir))


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC_COLS) for b in NUMERIC_COLS[i + 1:]]
A15_SQL = FEATS_CTE + ", c as (" + "\nunion all\n".join(
    f"select '{a}' as col_a, '{b}' as col_b, corr({_present(a)}, {_present(b)}) as corr from f" for a, b in _PAIRS) + \
    ")\nselect col_a, col_b, " + r6("corr") + " as corr from c where abs(corr) > 0.95 and not isnan(corr)"


@register("a15_high_correlation", with_fixtures(A15_SQL))
def a15_high_correlation(spark, sf_dir):
    """Numeric column pairs with |r| > 0.95 (pairwise-complete), all pairs in one aggregate."""
    c = P.high_correlations(_features(spark, sf_dir), NUMERIC_COLS)
    return rounded(c.where(F.col("corr").isNotNull() & ~F.isnan("corr")))


_UNPIVOT = (FEATS_CTE + ', u as (select "column", value from (unpivot (select ' +
            ", ".join(f"cast({c} as double) as {c}" for c in NUMERIC_COLS) +
            f' from f) on {", ".join(NUMERIC_COLS)} into name "column" value value) where not isnan(value))\n')
A16_SQL = _UNPIVOT + f"""select "column", count(*) as count, {r6('avg(value)')} as mean, {r6('stddev_samp(value)')} as std,
  {r6('min(value)')} as min, {r6('quantile_cont(value, 0.25)')} as q25, {r6('quantile_cont(value, 0.5)')} as q50,
  {r6('quantile_cont(value, 0.75)')} as q75, {r6('max(value)')} as max from u group by 1"""


@register("a16_describe", with_fixtures(A16_SQL))
def a16_describe(spark, sf_dir):
    """Count, mean, std, min, exact quartiles, max per numeric feature column."""
    return rounded(P.describe(_features(spark, sf_dir), NUMERIC_COLS))


A16R_SQL = _UNPIVOT + f""", d as (select "column", avg(value) as mean, stddev_samp(value) as std from u group by "column")
select {r6('min(mean)')} as mean_min, {r6('max(mean)')} as mean_max, {r6('min(std)')} as std_min, {r6('max(std)')} as std_max from d"""


@register("a16_describe_ranges", with_fixtures(A16R_SQL))
def a16_describe_ranges(spark, sf_dir):
    """Range of column means and deviations over the numeric feature columns."""
    return rounded(P.describe_ranges(P.describe(_features(spark, sf_dir), NUMERIC_COLS)))


Q05_SQL = _UNPIVOT + ", m as (" + "\nunion all\n".join(
    f"select cast(sum(case when {_miss(c)} then 1 else 0 end) as double) as n from f" for c in AUDIT_COLS) + "),\n" + \
    "k as (" + "\nunion all\n".join(
        f"select '{c}' as item, (count({_present(c)}) = 0 or min({_present(c)}) = max({_present(c)})) as is_constant from f"
        for c in AUDIT_COLS) + "),\n" + \
    "c as (" + "\nunion all\n".join(
        f"select '{a}~{b}' as item, corr({_present(a)}, {_present(b)}) as corr from f" for a, b in _PAIRS) + "),\n" + \
    """d as (select "column", avg(value) as mean, stddev_samp(value) as std from u group by "column")
select 'missing_values' as "check", 'total' as item, sum(n) as value from m
union all select 'constant_column', item, 1.0 from k where is_constant
union all select 'high_correlation', item, """ + r6("corr") + """ from c where abs(corr) > 0.95 and not isnan(corr)
union all select 'describe_range', 'mean_min', """ + r6("min(mean)") + """ from d
union all select 'describe_range', 'mean_max', """ + r6("max(mean)") + """ from d
union all select 'describe_range', 'std_min', """ + r6("min(std)") + """ from d
union all select 'describe_range', 'std_max', """ + r6("max(std)") + """ from d"""


@register("q05_feature_audit", with_fixtures(Q05_SQL))
def q05_feature_audit(spark, sf_dir):
    """Q05: the feature audit report - missing total, constant columns, correlated pairs, ranges."""
    return rounded(P.feature_audit(_features(spark, sf_dir).select(*AUDIT_COLS), NUMERIC_COLS))


@register("p06_fill_missing", with_fixtures(FEATS_CTE + "select sample_id, " + ", ".join(
    f"coalesce(case when isnan({c}) then null else {c} end, 0.0) as {c}" if c in FLOAT_COLS else f"coalesce({c}, 0) as {c}"
    for c in NUMERIC_COLS) + " from f"))
def p06_fill_missing(spark, sf_dir):
    """P04 + P06 + P08: numeric feature columns with NULL/NaN filled by 0."""
    f = _features(spark, sf_dir).select("sample_id", *NUMERIC_COLS)
    return P.fill_missing(f, 0.0, NUMERIC_COLS)


SPLIT_SQL = "case when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 100 then 'validation' else 'train' end"


@register("x01_train_val_split", with_fixtures(f"select sample_id, {SPLIT_SQL} as split from catalog"))
def x01_train_val_split(spark, sf_dir):
    """Seeded, partitioning-independent train/validation split by key hash."""
    return X.train_val_split(catalog(spark, sf_dir)).select("sample_id", "split")


@register("q04_dataset_profile", with_fixtures(f"""
select split, count(*) as n_rows, cast(4 as bigint) as n_columns, {r6('min(price)')} as price_min,
  {r6('max(price)')} as price_max, {r6('avg(price)')} as price_mean
from (select *, {SPLIT_SQL} as split from catalog) group by split"""))
def q04_dataset_profile(spark, sf_dir):
    """Q04: rows, columns and price range / mean per split."""
    return rounded(P.dataset_profile(X.train_val_split(catalog(spark, sf_dir))))


DECILE_SQL = """, e as (select list_distinct(quantile_cont(price, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) as edges from catalog),
lab as (select c.*, cast(len(list_filter(e.edges, lambda x: c.price > x)) as integer) as decile from catalog c, e)
"""


@register("w10_decile_labels", with_fixtures(DECILE_SQL + "select sample_id, price, decile from lab"))
def w10_decile_labels(spark, sf_dir):
    """Price decile label (qcut rule) of every product."""
    from ..operators.windows import decile_labels

    return decile_labels(catalog(spark, sf_dir).select("sample_id", "price"), "price")


@register("x02_stratified_split", with_fixtures(DECILE_SQL + """
, r as (select sample_id, decile, row_number() over (partition by decile order by md5('42:' || sample_id), sample_id) as rn,
          count(*) over (partition by decile) as n from lab)
select sample_id, decile, case when rn <= floor(n * 0.1 + 0.5) then 'validation' else 'train' end as split from r"""))
def x02_stratified_split(spark, sf_dir):
    """10 % validation within every price decile (partition-parallel ranks)."""
    return X.stratified_split(catalog(spark, sf_dir).select("sample_id", "price")).select("sample_id", "decile", "split")


@register("j01_join_keep_rows", with_fixtures(FEATS_CTE + """
select c.sample_id, c.image_link, c.price, f.text_length, f.ipq_unit_type, f.has_brand
from catalog c left join f on f.sample_id = c.sample_id"""))
def j01_join_keep_rows(spark, sf_dir):
    """Raw table x features on the key with the uniqueness check (row count kept)."""
    from ..operators.sets import join_keep_rows

    raw = catalog(spark, sf_dir).select("sample_id", "image_link", "price")
    feats = engineer_features(catalog(spark, sf_dir)).select("sample_id", "text_length", "ipq_unit_type", "has_brand")
    return join_keep_rows(raw, feats)


_DOC_COLS = [c for c in NUMERIC_COLS if c != "price"]
_DOC_PAIRS = [(a, b) for i, a in enumerate(_DOC_COLS) for b in _DOC_COLS[i + 1:]]


@register("a15_high_correlation_documents", with_fixtures(
    f", f as (select * from ({features_select('docs')})), c as (" + "\nunion all\n".join(
        f"select '{a}' as col_a, '{b}' as col_b, corr({_present(a)}, {_present(b)}) as corr from f" for a, b in _DOC_PAIRS)
    + ")\nselect col_a, col_b, " + r6("corr") + " as corr from c where abs(corr) > 0.95 and not isnan(corr)"))
def a15_high_correlation_documents(spark, sf_dir):
    """A15 on the features of whole documents (length-like columns correlate)."""
    from ..sources.derived import documents_as_catalog

    c = P.high_correlations(engineer_features(documents_as_catalog(spark, sf_dir)), _DOC_COLS)
    return rounded(c.where(F.col("corr").isNotNull() & ~F.isnan("corr")))
