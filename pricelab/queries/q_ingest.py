"""Registered queries: ingest, payload store and integrity (S12, Q06, Q07, I02-I04) over payloads made from every document.

A document's payload is its text between the markers of an image file, so integrity is decided by real bytes; its link is
a ``data:`` URL. Texts whose length divides by 5 lost their end marker, those whose length divides by 7 have no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ingest import ingest
from ..registry import register
from ..session import scratch_path, table
from ..sources import images as IM
from ..sources import payloads as P

BAD = "(n_chars % 5 = 0)"
LOST = "(n_chars % 7 = 0)"
LINKS_SQL = f"""links as (select cast(doc_id as varchar) as sample_id, 3 + octet_length(encode(coalesce(text, ''))) + case when {BAD} then 0 else 2 end as n_bytes,
  {BAD} as bad, {LOST} as lost from documents)"""


def _payloads(spark, sf_dir) -> DataFrame:
    start, end = F.unhex(F.lit("FFD8FF")), F.unhex(F.lit("FFD9"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    whole = F.when(F.expr(BAD), F.concat(start, text)).otherwise(F.concat(start, text, end))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), whole.alias("content"), F.expr(LOST).alias("lost"))


def _links(spark, sf_dir) -> DataFrame:
    link = F.concat(F.lit("data:image/jpeg;base64,"), F.translate(F.base64("content"), "\r\n", ""))  # no line breaks
    return _payloads(spark, sf_dir).select("sample_id", F.when(~F.col("lost"), link).alias("image_link"))


def _ingested(spark, sf_dir) -> str:
    path = scratch_path(spark, "payloads")
    # a payload in its own URL is not worth waiting for
    ingest(spark, _links(spark, sf_dir), path, sleep=lambda s: None)
    return path


@register("i02_i03_fetch_status", f"""with {LINKS_SQL}
select sample_id, not (bad or lost) as ok, cast(case when lost then 0 when bad then 3 else 1 end as integer) as attempts,
  case when lost then 'no link' when bad then 'corrupted payload' end as error, cast(case when bad or lost then 0 else n_bytes end as integer) as n_bytes
from links""")
def i02_i03_fetch_status(spark, sf_dir):
    """Every document's payload fetched in batches, up to three attempts each; outcome per id."""
    return P.payload_status(spark, _ingested(spark, sf_dir)).select(
        "sample_id", "ok", "attempts", "error", F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"))


@register("i04_ingest_resumed", f"""with {LINKS_SQL}, n as (select count(*) as total, count(*) filter (where not (bad or lost)) as good from links)
select 1 as run, good as success, total - good as failed, 0 as skipped, total from n
union all select 2, 0, total - good, good, total from n""")
def i04_ingest_resumed(spark, sf_dir):
    """The counts of a run and of the run after it, which leaves out what the first one has published."""
    path, links = scratch_path(spark, "payloads"), _links(spark, sf_dir)
    runs = [ingest(spark, links, path, sleep=lambda s: None).select(F.lit(i).alias("run"), "*") for i in (1, 2)]
    return runs[0].unionByName(runs[1])


@register("s12_scan_payloads", f"""with {LINKS_SQL}
select sample_id, n_bytes as length from links where not (bad or lost)""")
def s12_scan_payloads(spark, sf_dir):
    """The published payloads as a table of (id, length, bytes)."""
    files = P.scan_payloads(spark, _ingested(spark, sf_dir))
    return files.select("sample_id", "length")


@register("q06_payload_integrity", f"""with {LINKS_SQL}
select sample_id, case when lost or bad then 'corrupted' else 'valid' end as status, case when lost then 'no_file' when bad then 'bad_bytes' end as reason from links""")
def q06_payload_integrity(spark, sf_dir):
    """Q06: status and reason per id from the bytes themselves; an id without a payload is corrupted."""
    all_ = _payloads(spark, sf_dir)
    files = all_.where("not lost").select("sample_id", F.col("sample_id").alias("path"), F.octet_length("content").cast("long").alias("length"), "content")
    return IM.verify_images(files, all_.select("sample_id"))


@register("q07_payload_fallback", f"""with {LINKS_SQL}
select sample_id, bad or lost as is_fallback, cast(case when bad or lost then 128 end as double) as placeholder_value,
  case when bad or lost then 0 else n_bytes end as n_bytes from links""")
def q07_payload_fallback(spark, sf_dir):
    """Q07: each id's payload, or the placeholder where it has no valid one."""
    rows = _payloads(spark, sf_dir).select("sample_id")
    got = IM.with_fallback(rows, P.scan_payloads(spark, _ingested(spark, sf_dir)))
    return got.select("sample_id", "is_fallback", F.col("placeholder_value").cast("double").alias("placeholder_value"),
                      F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("n_bytes"))
