"""Secret scan with multipart credential linking.

One narrow pass finds strong spans (kinds assign, access, hex) and weak parts (identifier, secret,
endpoint) in every whole text. Weak parts say little alone: a weak secret is reported only where an
identifier, access key or endpoint lies within SCOPE code points, an identifier or endpoint only where a
secret of any kind does. That is an interval join within each document, done by two sorted windows (nearest
part before, nearest after) instead of pairs.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import body, staged

SCOPE = 200  # code points between parts of one credential
KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
SECRETS, PARTNERS = (0, 2, 4), (1, 3, 5)
MIN_ENTROPY = 3.5  # bits a character of a weak secret

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so this equals runs of any length with shorter ones dropped
IDENTIFIER = re.compile(r"""\b(?:user(?:name)?|client_?id|account(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.I | re.A)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]+")


def random_looking(token: str) -> bool:
    """Has lower and upper case and digits, and spreads its characters evenly."""
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= MIN_ENTROPY


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((start, kind, end) of strong spans, the same of weak parts), code points, end exclusive."""
    strong: list[tuple[int, int, int]] = []
    weak: list[tuple[int, int, int]] = []
    assigned = ":" in text or "=" in text
    if assigned:
        strong += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        weak += [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)]
    if "AKIA" in text:
        strong += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    strong += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "://" in text:
        weak += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    taken = sorted((s, e) for s, _, e in strong)
    for m in TOKEN.finditer(text):
        if random_looking(m[0]) and not any(s < m.end() and m.start() < e for s, e in taken):
            weak.append((m.start(), 4, m.end()))
    return sorted(strong), sorted(weak)


def _scanned(batches):
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    for batch in batches:
        found = [scan(t) for t in batch.column(2).to_pylist()]
        lists = [pa.array([[dict(zip(("start", "kind", "end"), s)) for s in f[i]] for f in found], span) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc_id", "h", "strong", "weak"])


def written(spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def linked_parts(scanned: DataFrame) -> DataFrame:
    """(doc_id, h, linked): the weak parts of each text that a complementary part is near to."""
    parts = scanned.where("size(weak) > 0 and size(weak) + size(strong) > 1").select("doc_id", "h").distinct()
    both = scanned.withColumn("part", F.explode(F.concat("strong", "weak"))).where("size(weak) > 0 and size(weak) + size(strong) > 1")
    parts = both.select("doc_id", "h", "part.*").distinct()
    text = Window.partitionBy("doc_id", "h")
    forward = text.orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    backward = text.orderBy(F.desc("start"), F.desc("kind"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    is_secret = F.col("kind").isin(*SECRETS)
    for name, cond in (("secret", is_secret), ("partner", ~is_secret)):
        parts = parts.withColumn(f"{name}_before", F.max(F.when(cond, F.col("end"))).over(forward))
        parts = parts.withColumn(f"{name}_after", F.min(F.when(cond, F.col("start"))).over(backward))

    def near(name: str):
        before = F.col("start") - F.col(f"{name}_before") <= SCOPE
        after = F.col(f"{name}_after") - F.col("end") <= SCOPE
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    hit = (F.col("kind") == 4) & near("partner") | F.col("kind").isin(3, 5) & near("secret")
    return parts.where(hit).groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "kind", "end")).alias("linked"))


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every row.

    ``spans`` are strong spans and linked weak parts as kind:start:end, by start, then kind. Null and empty
    texts have none; repeated rows each get the same result; null doc_ids pass through; other columns are
    not read; an empty table gives an empty result."""
    rows = documents.select("doc_id", F.xxhash64(body()).alias("h"), body().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start: long, kind: int, end: long>>"
    found = staged(rows.mapInArrow(_scanned, f"doc_id {kind}, h long, strong {spans}, weak {spans}"), "secret-spans")
    linked = linked_parts(found).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "linked")
    out = found.join(linked, found.doc_id.eqNullSafe(F.col("__id")) & (found.h == F.col("__h")), "left")
    every = F.array_sort(F.when(F.col("linked").isNull(), F.col("strong")).otherwise(F.concat("strong", "linked")))

    def count(k: int):
        return F.size(F.filter("strong", lambda s: s["kind"] == k)).cast("long")

    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
        written(every).alias("spans"), F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"),
    )
