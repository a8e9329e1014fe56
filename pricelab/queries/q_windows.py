"""Registered queries: manifest and history windows (W01-W09), batches, folds, ingest status and
set operations (A17, I01, J06-J08, U01-U05) on inputs derived from ``events`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets as S
from ..operators import windows as W
from ..oracle.fixtures import with_fixtures
from ..registry import r6, register, rounded
from ..session import table
from ..sources.derived import catalog, download_status, manifest


def _manifest(spark, sf_dir):
    return manifest(spark, sf_dir)


@register("w01_latest_entry", with_fixtures(f"""
select stage, event_id, checkpoint_type, {r6('metric')} as metric from (
  select *, row_number() over (partition by stage order by ts desc, event_id desc) as rn from manifest) where rn = 1"""))
def w01_latest_entry(spark, sf_dir):
    """Newest manifest entry per stage (partial aggregate of max(struct))."""
    return rounded(W.latest_entry(_manifest(spark, sf_dir)).select("stage", "event_id", "checkpoint_type", "metric"))


@register("w01_latest_entry_overall", with_fixtures(
    "select event_id, stage from manifest order by ts desc, event_id desc limit 1"))
def w01_latest_entry_overall(spark, sf_dir):
    """W01 over all stages."""
    return W.latest_entry(_manifest(spark, sf_dir), by=()).select("event_id", "stage")


@register("w02_retention_plan", with_fixtures("""
, r as (select *, row_number() over (partition by stage, checkpoint_type order by ts desc, event_id desc) as rn_new,
          row_number() over (partition by stage, checkpoint_type order by round(metric, 4) asc nulls last, ts desc, event_id desc) as rn_best,
          count(*) over (partition by stage, checkpoint_type) as n from manifest)
select stage, checkpoint_type, event_id, rn_new <= 3 or (rn_best = 1 and metric is not null) or n <= 3 as keep from r"""))
def w02_retention_plan(spark, sf_dir):
    """Keep the newest 3 per (stage, type) plus the best by metric; the rest is deleted."""
    return W.retention_plan(_manifest(spark, sf_dir)).select("stage", "checkpoint_type", "event_id", "keep")


@register("w03_manifest_listing", with_fixtures(
    "select event_id, stage, row_number() over (order by ts desc, event_id desc) as position from manifest"))
def w03_manifest_listing(spark, sf_dir):
    """Listing newest first, with the global position from the partition-parallel scan."""
    m = _manifest(spark, sf_dir).select("event_id", "stage", "ts")
    return W.manifest_listing(m, position="position").select("event_id", "stage", "position")


@register("w04_best_so_far", with_fixtures(f"""
, s as (select *, row_number() over (partition by stage order by ts, event_id) as step,
          min(metric) over (partition by stage order by ts, event_id rows between unbounded preceding and 1 preceding) as best_before,
          min(metric) over (partition by stage order by ts, event_id rows between unbounded preceding and current row) as best_so_far
        from manifest)
select stage, event_id, step, {r6('best_before')} as best_before, {r6('best_so_far')} as best_so_far,
  metric is not null and (best_before is null or metric < best_before) as is_new_best from s"""))
def w04_best_so_far(spark, sf_dir):
    """Running best before each step and the strictly-better flag, per stage."""
    b = W.best_so_far(_manifest(spark, sf_dir))
    return rounded(b.select("stage", "event_id", "step", "best_before", "best_so_far", "is_new_best"))


@register("w05_best_step", with_fixtures(f"""
select stage, event_id as best_step, {r6('metric')} as best_metric from (
  select *, row_number() over (partition by stage order by metric, event_id) as rn from manifest where metric is not null)
where rn = 1"""))
def w05_best_step(spark, sf_dir):
    """First step (event id) with the minimum metric, per stage."""
    return rounded(W.best_step(_manifest(spark, sf_dir)))


@register("w06_early_stop", with_fixtures("""
, s as (select *, row_number() over (partition by stage order by ts, event_id) as step,
          min(metric) over (partition by stage order by ts, event_id rows between unbounded preceding and 1 preceding) as bb
        from manifest),
f as (select stage, step, metric is not null and (bb is null or metric < bb) as is_new from s),
l as (select stage, step, max(case when is_new then step end) over (partition by stage order by step rows between unbounded preceding and current row) as last_imp from f),
st as (select stage, min(step) as stop_step from l where last_imp is not null and step - last_imp >= 20 group by stage),
fin as (select stage, max(step) as last_step, max(coalesce(last_imp, 0)) as last_imp from l group by stage)
select fin.stage, coalesce(st.stop_step, fin.last_step) as stop_step,
  coalesce((select max(last_imp) from l where l.stage = st.stage and l.step = st.stop_step), fin.last_imp) as best_step,
  st.stop_step is not null as stopped_early
from fin left join st on st.stage = fin.stage"""))
def w06_early_stop(spark, sf_dir):
    """Early stopping with patience 20 over each stage's metric history."""
    return W.early_stop(_manifest(spark, sf_dir), patience=20)


@register("w07_batch_numbers", """
select cast(o_orderkey as varchar) as sample_id, row_number() over (order by o_orderkey) - 1 as row_idx,
  (row_number() over (order by o_orderkey) - 1) // 5000 as batch from orders""")
def w07_batch_numbers(spark, sf_dir):
    """Row position and batch of 5000 in key order (partition-parallel row numbers)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    b = W.batch_numbers(o, 5000, ["o_orderkey"])
    return b.select(F.col("o_orderkey").cast("string").alias("sample_id"), "row_idx", "batch")


FOLD_SQL = "cast((('0x' || substr(md5('42:' || sample_id), 1, 7))::bigint % 5) as integer)"


@register("w09_shuffled_folds", with_fixtures(f"select sample_id, {FOLD_SQL} as fold from catalog"))
def w09_shuffled_folds(spark, sf_dir):
    """Seeded hash folds (5)."""
    return W.shuffled_folds(catalog(spark, sf_dir)).select("sample_id", "fold")


@register("w09_contiguous_folds", with_fixtures(
    "select sample_id, cast(ntile(5) over (order by price, sample_id) - 1 as integer) as fold from catalog"))
def w09_contiguous_folds(spark, sf_dir):
    """Contiguous folds over an order (ntile semantics, first n % k folds one row larger)."""
    return W.contiguous_folds(catalog(spark, sf_dir).select("sample_id", "price"), ["price", "sample_id"]).select("sample_id", "fold")


STATUS_SQL = """, inp as (select cast(o_orderkey as varchar) as sample_id, o_orderstatus from orders),
st as (select sample_id, case when o_orderstatus = 'F' then 'skipped' when o_orderstatus = 'P' then 'failed' else 'pending' end as status from inp)
"""


@register("a17_status_counts", with_fixtures(STATUS_SQL + """
select count(*) filter (where status = 'skipped') as skipped, count(*) filter (where status = 'failed') as failed,
  count(*) filter (where status = 'pending') as pending, count(*) as total from st"""))
def a17_status_counts(spark, sf_dir):
    """Ingest status counts (skipped = already done, failed, pending) and total."""
    ids, done, failed = download_status(spark, sf_dir)
    return S.status_counts(S.work_status(ids, done, failed))


@register("i01_pending_work", with_fixtures(STATUS_SQL + "select sample_id from st where status <> 'skipped'"))
def i01_pending_work(spark, sf_dir):
    """Input ids minus completed ids (anti join)."""
    ids, done, _failed = download_status(spark, sf_dir)
    return S.pending_work(ids, done).select("sample_id")


@register("j07_missing_extra_ids", """
select 'missing' as issue, cast(o_orderkey as varchar) as sample_id from orders
  where o_orderkey not in (select l_orderkey from lineitem)
union all
select distinct 'extra', cast(l_orderkey as varchar) from lineitem where l_orderkey not in (select o_orderkey from orders)""")
def j07_missing_extra_ids(spark, sf_dir):
    """Expected ids (orders) missing from the delivered ids (lineitem) and extra ones."""
    exp = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    got = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"))
    return S.missing_and_extra(exp, got)


@register("j08_coverage", f"""
select o_orderstatus, count(*) as n_ids, count(f) as n_found,
  {r6('avg(case when f is not null then 1 else 0 end) * 100.0')} as coverage_pct
from orders left join (select distinct l_orderkey, 1 as f from lineitem) l on l.l_orderkey = orders.o_orderkey
group by o_orderstatus""")
def j08_coverage(spark, sf_dir):
    """Share of orders that have line items, per order status."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample_id"))
    return rounded(S.coverage(o, li, by=["o_orderstatus"]))


@register("u01_id_overlap", "select o_orderkey as sample_id from orders intersect select l_orderkey from lineitem")
def u01_id_overlap(spark, sf_dir):
    """Ids present in both orders and lineitem."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample_id"))
    return S.id_overlap(o, li)


@register("u02_id_diff", "select distinct o_custkey as sample_id from orders where o_custkey not in (select c_custkey from customer)")
def u02_id_diff(spark, sf_dir):
    """Customer ids referenced by orders but absent from customer."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sample_id"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"))
    return S.id_diff(o, c)


@register("u03_merge_manifest", """
with rec as (
  select cast(o_orderkey as varchar) as sample_id, case when o_orderstatus = 'P' then 'failed' else 'completed' end as status, 1 as attempt
  from orders where o_orderstatus <> 'O'
  union all
  select cast(o_orderkey as varchar), case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'completed' else 'failed' end, 2
  from orders where o_orderstatus = 'P')
select sample_id, status, attempt from (select *, row_number() over (partition by sample_id order by attempt desc) as rn from rec) where rn = 1""")
def u03_merge_manifest(spark, sf_dir):
    """Progress records of two batches merged, latest status per id, no duplicates."""
    o = table(spark, sf_dir, "orders")
    first = o.where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").cast("string").alias("sample_id"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("status"), F.lit(1).alias("attempt"))
    retry = o.where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("string").alias("sample_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "completed").otherwise("failed").alias("status"),
        F.lit(2).alias("attempt"))
    return S.merge_manifest(first, retry)
