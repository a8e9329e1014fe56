"""Registered queries: distributions (A09-A11), value transforms (P09-P15), top-k (T01-T05),
function variants (F04, F10, F15, F17, F18), submission (Q01-Q03) and sources / sinks (S01-S15, R03)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import errors as E
from ..functions.charclass import UPPER_CLASS
from ..functions.ipq import compiled_patterns, ipq_ranked_columns
from ..functions.names import checkpoint_name, has_stage_prefix, metric_from_name, stem
from ..functions.text import brand_plan_columns, uppercase_share_of_all
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import sets as S
from ..operators import splits as X
from ..operators import tfidf as T
from ..operators.windows import batch_numbers
from ..oracle.fixtures import with_fixtures
from ..oracle.sqlfeatures import ascii_digits, count_class, features_select, q
from ..plans import submission as SUB
from ..plans.features import engineer_features
from ..registry import r6, register, rnd_sql, round_col, rounded
from ..session import scratch_path, table
from ..sources import store as ST
from ..sources.derived import catalog, download_status, manifest, predictions
from .q_metrics import PCT_SQL
from .common import NUMERIC_COLS
from .q_tfidf import _long_sql, _vocab_sql

SPLIT_SQL = "case when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 100 then 'validation' else 'train' end"
SPLIT3_SQL = ("case when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 100 then 'validation' "
              "when (('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 1000) < 200 then 'test' else 'train' end")


# ---- distributions ------------------------------------------------------------------------------
@register("a09_split_histogram", with_fixtures(f"""
, x as (select {SPLIT_SQL} as split, ln(1 + price) as _x from catalog where price is not null and not isnan(price)),
r as (select min(_x) as a, max(_x) as b from x where split = 'train'),
e as (select list_concat(list_transform(range(0, 49), lambda i: a + i * ((b - a) / 49)), [b]) as edges, a, b from r),
xb as (select split, least(len(list_filter(edges, lambda v: v <= _x)) - 1, 48) as bin from x cross join e where _x >= e.a and _x <= e.b),
c as (select split, bin, count(*) as n from xb group by all),
g as (select s.split, unnest(range(0, 49)) as bin from (select distinct split from x) s)
select g.split, cast(g.bin as integer) as bin, {r6('e.edges[g.bin + 1]')} as lo, {r6('e.edges[g.bin + 2]')} as hi,
  coalesce(c.n, 0) as n
from g cross join e left join c on c.split = g.split and c.bin = g.bin"""))
def a09_split_histogram(spark, sf_dir):
    """Log-price histogram per split on 50 edges spanning the train split."""
    c = X.train_val_split(catalog(spark, sf_dir)).where(~E.is_missing(F.col("price")))
    c = c.withColumn("log_price", F.log(1 + F.col("price")))
    return rounded(M.split_histogram(c, "log_price", "split", "train", 50, log1p=False))


@register("a10_box_summary", with_fixtures(f"""
, x as (select {SPLIT_SQL} as split, price from catalog where price is not null and not isnan(price)),
q as (select split, quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.5) as median, quantile_cont(price, 0.75) as q3 from x group by split)
select x.split, count(*) as n, {r6('avg(price)')} as mean, {r6('any_value(q1)')} as q1, {r6('any_value(median)')} as median,
  {r6('any_value(q3)')} as q3, {r6('min(case when price >= q1 - 1.5 * (q3 - q1) then price end)')} as whisker_lo,
  {r6('max(case when price <= q3 + 1.5 * (q3 - q1) then price end)')} as whisker_hi
from x join q on q.split = x.split group by x.split"""))
def a10_box_summary(spark, sf_dir):
    """A10: box-plot numbers per split (exact quartiles, 1.5 IQR whiskers on data points)."""
    return rounded(M.box_summary(X.train_val_split(catalog(spark, sf_dir)), "price", by=["split"]))


def _acklam_sql(p: str) -> str:
    def poly(coefs, x):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc} * {x} + {c!r})"
        return acc

    ql = f"sqrt(-2 * ln({p}))"
    qh = f"sqrt(-2 * ln(1 - {p}))"
    qq = f"({p} - 0.5)"
    r = f"({qq} * {qq})"
    lo = f"{poly(M._C, ql)} / ({poly(M._D, ql)} * {ql} + 1)"
    hi = f"-{poly(M._C, qh)} / ({poly(M._D, qh)} * {qh} + 1)"
    mid = f"{poly(M._A, r)} * {qq} / ({poly(M._B, r)} * {r} + 1)"
    return f"case when {p} < 0.02425 then {lo} when {p} > {1 - 0.02425!r} then {hi} else {mid} end"


@register("a11_qq_fit", with_fixtures(f"""
, x as (select {PCT_SQL} as v from preds where model = 'lightgbm'),
r as (select v, row_number() over (order by v) as i, count(*) over () as n from x),
m as (select v, case when i = 1 then 1 - pow(0.5, 1.0 / n) when i = n then pow(0.5, 1.0 / n) else (i - 0.3175) / (n + 0.365) end as p from r),
o as (select v, {_acklam_sql('p')} as osm from m)
select count(*) as n, {r6('regr_slope(v, osm)')} as slope, {r6('regr_intercept(v, osm)')} as intercept, {r6('corr(osm, v)')} as r from o"""))
def a11_qq_fit(spark, sf_dir):
    """Normal Q-Q fit of one model's percent errors (ranks from the partition-parallel scan)."""
    p = predictions(spark, sf_dir).where(F.col("model") == "lightgbm")
    x = p.select(E.percent_error(F.col("y_true"), F.col("pred")).alias("v"))
    return rounded(M.qq_fit(x, "v"))


@register("a11_qq_fit_by_model", with_fixtures(f"""
, x as (select model, {PCT_SQL} as v from preds),
r as (select model, v, row_number() over (partition by model order by v) as i, count(*) over (partition by model) as n from x),
m as (select model, v, case when i = 1 then 1 - pow(0.5, 1.0 / n) when i = n then pow(0.5, 1.0 / n) else (i - 0.3175) / (n + 0.365) end as p from r),
o as (select model, v, {_acklam_sql('p')} as osm from m)
select model, count(*) as n, {r6('regr_slope(v, osm)')} as slope, {r6('regr_intercept(v, osm)')} as intercept, {r6('corr(osm, v)')} as r
from o group by model"""))
def a11_qq_fit_by_model(spark, sf_dir):
    """The same fit for each of the models, in one scan."""
    p = predictions(spark, sf_dir)
    x = p.select("model", E.percent_error(F.col("y_true"), F.col("pred")).alias("v"))
    return rounded(M.qq_fit(x, "v", ["model"]))


# ---- value transforms ---------------------------------------------------------------------------
def _clip_sql(x: str, lo: str | None, hi: str | None) -> str:
    e = x
    if lo is not None:
        e = f"greatest({e}, {lo})"
    if hi is not None:
        e = f"least({e}, {hi})"
    return f"case when {x} is null then null when isnan({x}) then {x} else {e} end"


@register("p09_p11_clip_and_floor", with_fixtures(f"""
select sample_id, model, {_clip_sql('pred', '0.0', '50000.0')} as clipped, {_clip_sql('pred', '0.01', None)} as floored,
  {_clip_sql('y_true', '1.0', None)} as floor_one from preds"""))
def p09_p11_clip_and_floor(spark, sf_dir):
    """Clip to [0, 50000], floor at 0.01, floor at 1 (NULL and NaN kept, as numpy does)."""
    p = predictions(spark, sf_dir)
    return p.select("sample_id", "model", E.clip(F.col("pred"), 0.0, 50000.0).alias("clipped"),
                    E.floor_at(F.col("pred"), 0.01).alias("floored"), E.floor_at(F.col("y_true"), 1.0).alias("floor_one"))


@register("p14_price_per_unit", with_fixtures(f"""
, f as (select * from ({features_select('catalog', keep=('price',))}))
select sample_id, case when price is not null and not isnan(price) and ipq_normalized is not null and not isnan(ipq_normalized)
  then price / greatest(ipq_normalized, 1e-6) end as price_per_unit from f"""))
def p14_price_per_unit(spark, sf_dir):
    """Price per normalised unit, NULL when either is missing."""
    f = engineer_features(catalog(spark, sf_dir), keep=["price"])
    return f.select("sample_id", E.price_per_unit(F.col("price"), F.col("ipq_normalized")).alias("price_per_unit"))


def _u_sql(stream: int) -> str:
    return f"((('0x' || substr(md5('7:{stream}:' || sample_id), 1, 13))::bigint + 1.0) / 4503599627370497.0)"


@register("p15_noisy_predictions", with_fixtures(f"""
select sample_id, model, {r6(f"greatest(pred * (1.0 + 0.001 * (sqrt(-2.0 * ln({_u_sql(1)})) * cos({2 * 3.141592653589793!r} * {_u_sql(2)}))), 0.01)")} as noisy
from preds"""))
def p15_noisy_predictions(spark, sf_dir):
    """Reproducible multiplicative noise N(0, 0.001) per id (seed 7), floored at 0.01."""
    p = predictions(spark, sf_dir)
    return rounded(p.select("sample_id", "model", E.noisy_prediction(F.col("pred"), F.col("sample_id"), 7).alias("noisy")))


# ---- top-k ---------------------------------------------------------------------------------------
_T01_COLS = [c for c in NUMERIC_COLS if c != "price"]


@register("t01_top_k_features", with_fixtures(f"""
, f as (select * from ({features_select('catalog', keep=('price',))})),
c as ({' union all '.join(f"select '{c}' as feature, abs(corr({c}, price)) as importance from f" for c in _T01_COLS)})
select feature, {r6('importance')} as importance from c where importance is not null and not isnan(importance)
order by importance desc, feature limit 5"""))
def t01_top_k_features(spark, sf_dir):
    """The 5 features with the highest |correlation| with price, descending."""
    f = engineer_features(catalog(spark, sf_dir), keep=["price"])
    wide = f.agg(*[P.pairwise_corr(c, "price").alias(c) for c in _T01_COLS])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.col(c)).alias("importance"))
                                           for c in _T01_COLS])).alias("s")).select("s.*")
    long = long.where(F.col("importance").isNotNull() & ~F.isnan("importance"))
    return rounded(long).orderBy(F.col("importance").desc(), F.col("feature")).limit(5)


@register("t03_debug_subset", with_fixtures("select * from catalog order by sample_id limit 100"))
def t03_debug_subset(spark, sf_dir):
    """The first 100 rows by key (top-k, no full sort)."""
    return catalog(spark, sf_dir).orderBy("sample_id").limit(100)


def _submission(spark, sf_dir):
    p = X.train_val_test_split(predictions(spark, sf_dir).where(F.col("model") == "lightgbm"))
    return SUB.build_submission(p.where(F.col("split") == "test"))


SUB_SQL = f", sub as (select sample_id, {_clip_sql('pred', '0.0', None)} as price from preds where model = 'lightgbm' and {SPLIT3_SQL} = 'test')\n"


@register("q02_build_submission", with_fixtures(SUB_SQL + "select * from sub"))
def q02_build_submission(spark, sf_dir):
    """Q02: test-split predictions -> (sample_id, price) clipped at 0."""
    return _submission(spark, sf_dir)


@register("t04_preview", with_fixtures(SUB_SQL + "select * from sub order by sample_id limit 10"))
def t04_preview(spark, sf_dir):
    """First 10 rows of the submission."""
    return _submission(spark, sf_dir).orderBy("sample_id").limit(10)


@register("t05_download_limit", with_fixtures("""
select cast(o_orderkey as varchar) as sample_id from orders where o_orderstatus <> 'F' order by cast(o_orderkey as varchar) limit 1000"""))
def t05_download_limit(spark, sf_dir):
    """At most 1000 pending downloads (by key)."""
    ids, done, _ = download_status(spark, sf_dir)
    return S.pending_work(ids, done).select("sample_id").orderBy("sample_id").limit(1000)


@register("q01_q03_validate_submission", with_fixtures(SUB_SQL + f"""
, exp as (select distinct cast(o_orderkey as varchar) as sample_id from orders join lineitem on l_orderkey = o_orderkey
          where {SPLIT3_SQL.replace('sample_id', 'cast(o_orderkey as varchar)')} = 'test'),
chk as (
  select 'column_sample_id' as "check", 'error' as severity, 0 as n
  union all select 'column_price', 'error', 0
  union all select 'missing_ids', 'error', (select count(*) from exp where sample_id not in (select sample_id from sub))
  union all select 'extra_ids', 'warning', (select count(*) from sub where sample_id not in (select sample_id from exp))
  union all select 'nan_prices', 'error', (select count(*) from sub where isnan(price))
  union all select 'negative_prices', 'error', (select count(*) from sub where price < 0)
  union all select 'infinite_prices', 'error', (select count(*) from sub where isinf(price))
  union all select 'non_positive_prices', 'error', (select count(*) from sub where not (price > 0) or price is null or isnan(price))
  union all select 'duplicate_ids', 'error', (select count(*) - count(distinct sample_id) from sub)
  union all select 'row_count_difference', 'error', (select abs((select count(*) from sub) - (select count(*) from exp))))
select "check", severity, cast(n as bigint) as n, n = 0 as ok from chk"""))
def q01_q03_validate_submission(spark, sf_dir):
    """Q01 + Q03: submission checks against the expected ids (test orders that have line items)."""
    sub = _submission(spark, sf_dir)
    o = X.train_val_test_split(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id")))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"))
    exp = o.where(F.col("split") == "test").join(li, "sample_id", "left_semi")
    return SUB.validation_report(sub, exp)


# ---- function variants ---------------------------------------------------------------------------
def _ranked_sql() -> str:
    raw, unit, rank = [], [], []
    for i, (rx, groups, _implied) in enumerate(compiled_patterns()):
        g1 = f"regexp_extract(_low, {q(rx)}, 1)"
        raw.append(f"WHEN {g1} <> '' THEN {g1}")
        unit.append(f"WHEN {g1} <> '' THEN " + (f"regexp_extract(_low, {q(rx)}, 2)" if groups > 1 else "'count'"))
        rank.append(f"WHEN {g1} <> '' THEN {i}")
    from .. import constants as C

    units = ", ".join(f"({q(u)}, {float(fa)!r})" for u, (_t, fa) in C.UNIT_CONVERSIONS.items())
    return f""", m as (select sample_id, CASE {' '.join(raw)} END as _raw, CASE {' '.join(unit)} END as _unit,
   CASE {' '.join(rank)} END as _rank from (select sample_id, lower(coalesce(catalog_content, '')) as _low from catalog))
select m.sample_id, cast({ascii_digits('_raw')} as double) as ipq_value, coalesce(_unit, 'unknown') as ipq_unit,
  cast({ascii_digits('_raw')} as double) * coalesce(u.factor, 1.0) as ipq_normalized,
  case when _raw is null then 0.0 else 0.9::double - 0.05::double * _rank end as ipq_confidence
from m left join (values {units}) u(unit, factor) on u.unit = m._unit"""


@register("f04_pack_quantity_ranked", with_fixtures(_ranked_sql()))
def f04_pack_quantity_ranked(spark, sf_dir):
    """plan variant of the pack quantity (confidence by pattern rank, 'unknown' unit)."""
    c = catalog(spark, sf_dir)
    return c.select("sample_id", *ipq_ranked_columns(F.coalesce(F.col("catalog_content"), F.lit(""))))


@register("f10_f15_plan_text_variants", with_fixtures(f"""
, t as (select sample_id, catalog_content as t, coalesce(catalog_content, '') as c from catalog),
w as (select *, string_split_regex(regexp_replace(c, '^\\s+', ''), '\\s+')[1] as w1,
        regexp_extract(t, {q(r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b")}, 1) as caps, regexp_extract(t, {q("([A-Z][a-z]+'s)")}, 1) as poss from t),
b as (select *, (w1 is not null and length(w1) > 2 and regexp_matches(substr(w1, 1, 1), '^\\p{{Lu}}$')) as first_ok,
        case when caps <> '' then caps when poss <> '' then poss end as found from w)
select sample_id,
  CAST({count_class('c', UPPER_CLASS)} AS DOUBLE) / greatest(length(c), 1) as upper_share,
  coalesce(t is not null and (first_ok or found is not null), false) as has_brand,
  case when t is null then -1.0 when first_ok then 0.0 when found is not null then (instr(t, found) - 1) / greatest(length(t), 1)
       else -1.0 end as brand_position,
  case when t is null then '' when first_ok then w1 else coalesce(found, '') end as potential_brand
from b"""))
def f10_f15_plan_text_variants(spark, sf_dir):
    """F10 + F15: plan variants - upper-case share of all characters, brand by first word or regex."""
    c = catalog(spark, sf_dir)
    return c.select("sample_id", uppercase_share_of_all(F.col("catalog_content")).alias("upper_share"),
                    *brand_plan_columns(F.col("catalog_content")))


@register("f17_checkpoint_names", with_fixtures("""
, n as (select event_id, stage || '_' || checkpoint_type || '_' || replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), ':', '-')
          || case when metric is not null then '_metric' || printf('%.4f', metric) else '' end || '.pt' as name from manifest)
select event_id, name, regexp_extract(name, '^(.*?)(\\.[^.]*)?$', 1) as stem, starts_with(name, 'click_') as is_click,
  case when regexp_extract(name, '_metric(.*?)\\.pt$', 1) <> '' then try_cast(regexp_extract(name, '_metric(.*?)\\.pt$', 1) as double) end as metric
from n"""))
def f17_checkpoint_names(spark, sf_dir):
    """checkpoint file names built from the manifest and parsed back (stem, stage prefix, metric)."""
    m = manifest(spark, sf_dir)
    ts_text = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    n = m.select("event_id", checkpoint_name(F.col("stage"), F.col("checkpoint_type"), ts_text, F.col("metric")).alias("name"))
    return n.select("event_id", "name", stem(F.col("name")).alias("stem"), has_stage_prefix(F.col("name"), "click").alias("is_click"),
                    metric_from_name(F.col("name")).alias("metric"))


@register("f18_report_titles", with_fixtures(
    "select upper(model) || ' METRICS' as title, " + rnd_sql("100 * avg(abs(pred - y_true) / ((abs(y_true) + abs(pred)) / 2.0 + 1e-10))", 4)
    + " as smape from preds group by model"))
def f18_report_titles(spark, sf_dir):
    """report titles and 4-decimal SMAPE per model."""
    s = M.smape(predictions(spark, sf_dir), by=["model"])
    return s.select(E.split_title(F.col("model")).alias("title"), round_col(F.col("smape"), 4).alias("smape"))


@register("m06_non_finite_flags", with_fixtures(f"""
select sample_id, model, isnan(pred) as is_nan, isinf(pred) as is_inf, pred < 0 as is_negative,
  {r6('ln(1 + y_true)')} as log_target from preds"""))
def m06_non_finite_flags(spark, sf_dir):
    """M01 + M06: NaN / infinite / negative flags and the log-space target."""
    p = predictions(spark, sf_dir)
    return rounded(p.select("sample_id", "model", *E.non_finite_flags(F.col("pred")), F.log1p(F.col("y_true")).alias("log_target")))


# ---- sources and sinks ---------------------------------------------------------------------------
@register("s01_s02_csv_round_trip", with_fixtures("select * from catalog"))
def s01_s02_csv_round_trip(spark, sf_dir):
    """S01 + S02: the catalog written as quoted CSV with a header and read back with an explicit schema
    (NULL and empty texts stay apart)."""
    path = scratch_path(spark, "catalog-csv")
    ST.write_csv(catalog(spark, sf_dir), path, null_marker="\\N")
    return ST.read_csv(spark, path, null_marker="\\N")


@register("s01_csv_documents", "select cast(doc_id as varchar) as sample_id, text as catalog_content, null::varchar as image_link, "
                               "cast(n_chars as double) as price from documents")
def s01_csv_documents(spark, sf_dir):
    """S01 on whole multi-line documents (quotes, newlines)."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), F.col("text").alias("catalog_content"),
                                                  F.lit(None).cast("string").alias("image_link"), F.col("n_chars").cast("double").alias("price"))
    path = scratch_path(spark, "documents-csv")
    ST.write_csv(d, path)
    return ST.read_csv(spark, path)


@register("s03_s04_feature_store", with_fixtures(f"select * from ({features_select('catalog', keep=('price',))})"))
def s03_s04_feature_store(spark, sf_dir):
    """S03 + S04: features written to the Parquet feature store and read back (lossless)."""
    f = engineer_features(catalog(spark, sf_dir), keep=["price"])
    path = scratch_path(spark, "features")
    ST.write_parquet(f, path)
    back = ST.read_parquet(spark, path)
    a, b = ST.round_trip_differences(f, back)
    if a or b:
        raise AssertionError(f"feature store round trip differs: {a} / {b} rows")
    return back


@register("s05_vectorizer_round_trip", with_fixtures(
    _vocab_sql("catalog") + _long_sql("catalog") + f"select sample_id, term_index, term, {r6('tfidf')} as tfidf from long"))
def s05_vectorizer_round_trip(spark, sf_dir):
    """Fitted vocabulary saved as Parquet, loaded, and used to transform (same entries as V04)."""
    c = catalog(spark, sf_dir)
    path = scratch_path(spark, "vocab")
    fitted = T.fit(c)
    fitted.save(path)
    loaded = T.TfidfModel.load(spark, path)
    if ST.round_trip_differences(fitted.vocab, loaded.vocab) != (0, 0):
        raise AssertionError("the loaded vocabulary differs from the fitted one")
    return rounded(T.transform_long(loaded, c))


@register("s06_s07_prediction_store", with_fixtures(f"""
select sample_id, y_true, pred, model, split from (select *, {SPLIT3_SQL} as split from preds)
where model = 'lightgbm' and split = 'validation'"""))
def s06_s07_prediction_store(spark, sf_dir):
    """S06 + S07: predictions stored partitioned by (model, split); one source read back by partition filter."""
    p = X.train_val_test_split(predictions(spark, sf_dir))
    path = scratch_path(spark, "pred-store")
    ST.save_predictions(p, path)
    return ST.select_source(spark, path, "lightgbm").where(F.col("split") == "validation")


@register("s08_available_models", with_fixtures("""
select m.model, m.model in (select distinct model from preds) as present
from (values ('catboost'), ('ensemble'), ('lightgbm'), ('neural_net'), ('xgboost')) m(model)"""))
def s08_available_models(spark, sf_dir):
    """Which expected model sources exist in the store (missing ones flagged, not failing)."""
    path = scratch_path(spark, "pred-store")
    ST.save_predictions(X.train_val_test_split(predictions(spark, sf_dir)), path)
    return ST.available_models(spark, path, ["catboost", "ensemble", "lightgbm", "neural_net", "xgboost"])


@register("s09_r03_progress_json", """
select cast(o_orderkey as varchar) as sample_id, case when o_orderstatus = 'F' then 'completed' else 'failed' end as status
from orders where o_orderstatus in ('F', 'P')""")
def s09_r03_progress_json(spark, sf_dir):
    """S09 + R03 + I04: per-batch progress records (arrays of ids) as JSON lines, read back into sets."""
    ids, done, failed = download_status(spark, sf_dir)
    st = S.work_status(ids, done, failed)
    b = batch_numbers(st.select("sample_id", "status"), 5000, ["sample_id"])
    rec = b.groupBy("batch").agg(
        F.collect_list(F.when(F.col("status") == "skipped", F.col("sample_id"))).alias("completed"),
        F.collect_list(F.when(F.col("status") == "failed", F.col("sample_id"))).alias("failed"))  # <= 5000 per batch
    path = scratch_path(spark, "progress")
    ST.write_progress(rec, path, mode="overwrite")
    return ST.read_progress(spark, path)


@register("s13_sample_sink", with_fixtures("select * from catalog order by sample_id limit 100"))
def s13_sample_sink(spark, sf_dir):
    """First 100 rows by key written as one CSV and read back."""
    path = scratch_path(spark, "sample")
    ST.write_sample(catalog(spark, sf_dir), path, null_marker="\\N")
    return ST.read_csv(spark, path, null_marker="\\N")


@register("s15_timestamped_output", with_fixtures(SUB_SQL + "select * from sub"))
def s15_timestamped_output(spark, sf_dir):
    """The submission written once with a timestamp and once as 'latest'; the latest copy read back."""
    base = scratch_path(spark, "submissions")
    _stamped, latest = ST.write_timestamped(_submission(spark, sf_dir), base)
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    return ST.read_csv(spark, latest, StructType([StructField("sample_id", StringType()), StructField("price", DoubleType())]))


@register("a03_lineitem_evaluation", f"""
select l_returnflag, {r6('100 * avg(abs(p - t) / ((abs(t) + abs(p)) / 2.0 + 1e-10))')} as smape, {r6('avg(abs(t - p))')} as mae,
  {r6('sqrt(avg((t - p) * (t - p)))')} as rmse, {r6('100 * avg(abs((t - p) / (t + 1e-10)))')} as mape,
  {r6('1 - sum((t - p) * (t - p)) / (var_pop(t) * count(t))')} as r2
from (select l_returnflag, l_extendedprice as t, l_extendedprice * (1 - l_discount) * (1 + l_tax) as p from lineitem)
group by l_returnflag""")
def a03_lineitem_evaluation(spark, sf_dir):
    """A03 on every lineitem: net price after discount and tax as the 'prediction' of the list price,
    per return flag (the bench's evaluation record)."""
    li = table(spark, sf_dir, "lineitem")
    p = li.select("l_returnflag", F.col("l_extendedprice").alias("y_true"),
                  (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("pred"))
    return rounded(M.evaluation_record(p, by=["l_returnflag"]))


@register("a04_lineitem_quintiles", f"""
, x as (select l_extendedprice as y_true, l_extendedprice * (1 - l_discount) * (1 + l_tax) as pred from lineitem),
e as (select quantile_cont(y_true, [0.2, 0.4, 0.6, 0.8]) as edges from x),
b as (select y_true, pred, 1 + len(list_filter(e.edges, lambda v: v <= x.y_true)) as quantile from x cross join e)
select cast(quantile as integer) as quantile, printf('[%.2f, %.2f]', min(y_true), max(y_true)) as price_range,
  {r6('min(y_true)')} as price_min, {r6('max(y_true)')} as price_max, count(*) as count,
  {r6('100 * avg(abs(pred - y_true) / ((abs(y_true) + abs(pred)) / 2.0 + 1e-10))')} as smape
from b group by quantile""".replace("\n, x as", "with x as", 1))
def a04_lineitem_quintiles(spark, sf_dir):
    """A04 over all of ``lineitem`` (exact global quintile edges without a single-task percentile)."""
    li = table(spark, sf_dir, "lineitem")
    p = li.select(F.col("l_extendedprice").alias("y_true"),
                  (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("pred"))
    return rounded(M.smape_by_quantile(p))



def _s14_sql() -> str:
    from ..sources import synthetic as SY

    def u(stream):
        return f"((('0x' || substr(md5('42:{stream}:' || cast(p_partkey as varchar)), 1, 13))::bigint + 1.0) / 4503599627370497.0)"

    def pick(stream, n):
        return f"cast(least(floor({u(stream)} * {n}), {n - 1}) as integer)"

    cats = "[" + ", ".join(q(c) for c, _, _ in SY.CATEGORIES) + "]"
    los = "[" + ", ".join(repr(math.log(a)) for _, a, _ in SY.CATEGORIES) + "]"
    his = "[" + ", ".join(repr(math.log(b)) for _, _, b in SY.CATEGORIES) + "]"
    qts = "[" + ", ".join(q(x) for x in SY.QUANTITIES) + "]"
    qls = "[" + ", ".join(q(x) for x in SY.QUALITY) + "]"
    descs = "[" + ", ".join(f"replace(replace({q(t)}, '{{c}}', lower(cat)), '{{C}}', cat)" for t in SY.DESCRIPTIONS) + "]"
    return f"""
select sample_id, trim(concat_ws(' ', qual, cat, 'Product', sample_id, qty)) as product_name,
  {descs}[{pick(5, len(SY.DESCRIPTIONS))} + 1] as catalog_content, cat as category,
  'https://example.com/images/' || sample_id || '.jpg' as image_link,
  floor(exp(lo + {u(2)} * (hi - lo)) * 100 + 0.5) / 100 as price
from (select p_partkey, cast(p_partkey as varchar) as sample_id,
        {cats}[{pick(1, len(SY.CATEGORIES))} + 1] as cat, {los}[{pick(1, len(SY.CATEGORIES))} + 1] as lo,
        {his}[{pick(1, len(SY.CATEGORIES))} + 1] as hi, {qts}[{pick(3, len(SY.QUANTITIES))} + 1] as qty,
        {qls}[{pick(4, len(SY.QUALITY))} + 1] as qual from part)"""


@register("s14_synthetic_catalog", _s14_sql())
def s14_synthetic_catalog(spark, sf_dir):
    """One synthetic validation product per ``part`` key (deterministic per seed and key)."""
    from ..sources.synthetic import synthetic_catalog

    return synthetic_catalog(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")
