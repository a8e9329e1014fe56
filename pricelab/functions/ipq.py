"""Pack quantity (value, unit, normalised value, unit type) as one expression.

Semantics: lower-case the text, try the patterns in list order, the first *pattern* that matches
anywhere wins (not the leftmost match; no word boundaries, so ``10 mm`` is read as 10 ``m``).
NULL or empty text gives the empty record. Everything is a Catalyst expression: ``coalesce`` over
``when`` branches is evaluated lazily per row, so a row stops at its first matching pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .charclass import decimal_digit_map, py_regex_to_portable

IPQ_FIELDS = ["ipq_value", "ipq_unit", "ipq_normalized", "ipq_unit_type", "ipq_confidence", "has_ipq"]


def implied_unit(pattern: str) -> str:
    """Unit of a one-group pattern, decided by the words in the pattern text."""
    if "pack" in pattern:
        return "pack"
    if "count" in pattern:
        return "count"
    if "piece" in pattern or "pcs" in pattern:
        return "pieces"
    return "count"


def compiled_patterns(word_boundary: bool = False) -> list[tuple[str, int, str | None]]:
    """(portable regex, number of groups, implied unit) per pattern, in order."""
    out = []
    for p in C.IPQ_PATTERNS:
        groups = p.count("(") - p.count("(?:")
        rx = py_regex_to_portable(p)
        if word_boundary:
            rx = r"(?<![\p{L}\p{N}])" + rx + r"(?![\p{L}\p{N}])"
        out.append((rx, groups, None if groups > 1 else implied_unit(p)))
    return out


def unit_map() -> Column:
    """Unit dimension as a map literal: unit -> struct(unit_type, factor). 39 fixed entries."""
    kv = []
    for unit, (utype, factor) in C.UNIT_CONVERSIONS.items():
        kv += [F.lit(unit), F.struct(F.lit(utype).alias("unit_type"), F.lit(float(factor)).alias("factor"))]
    return F.create_map(*kv)


def ascii_digits(c: Column) -> Column:
    src, dst = decimal_digit_map()
    return F.translate(c, src, dst)


def ipq_match(low: Column, word_boundary: bool = False) -> Column:
    """struct(raw, unit) of the first matching pattern, NULL if none matches.

    ``low`` is the lower-cased text; compute it once as its own column and pass it in.
    """
    branches = []
    for rx, groups, implied in compiled_patterns(word_boundary):
        first = F.regexp_extract(low, rx, 1)
        unit = F.regexp_extract(low, rx, 2) if groups > 1 else F.lit(implied)
        branches.append(F.when(first != "", F.struct(first.alias("raw"), unit.alias("unit"))))
    return F.coalesce(*branches)


def ipq_finish(hit: Column) -> list[Column]:
    """Turn the matched (raw, unit) struct into the six output columns."""
    value = ascii_digits(hit["raw"]).cast("double")
    unit = hit["unit"]
    dim = F.try_element_at(unit_map(), unit)
    known = dim.isNotNull()
    matched = hit.isNotNull()
    return [
        value.alias("ipq_value"),
        unit.alias("ipq_unit"),
        (value * dim["factor"]).alias("ipq_normalized"),
        dim["unit_type"].alias("ipq_unit_type"),
        F.when(~matched, F.lit(C.IPQ_CONFIDENCE_NONE))
        .when(known, F.lit(C.IPQ_CONFIDENCE_KNOWN))
        .otherwise(F.lit(C.IPQ_CONFIDENCE_UNKNOWN))
        .alias("ipq_confidence"),
        matched.alias("has_ipq"),
    ]


def normalize_quantity(value: Column, unit: Column) -> Column:
    """value in the standard unit of its dimension (NULL for unknown units)."""
    return value * F.try_element_at(unit_map(), unit)["factor"]


def denormalize_quantity(normalized: Column, unit: Column) -> Column:
    """F03 inverse: from the standard unit back to ``unit``."""
    return normalized / F.try_element_at(unit_map(), unit)["factor"]


def unit_table(spark):
    """J05 as a dimension table (39 rows) for joins."""
    rows = [(u, t, float(f)) for u, (t, f) in C.UNIT_CONVERSIONS.items()]
    return spark.createDataFrame(rows, "unit string, unit_type string, factor double")


# ---- plan variant F04: confidence by pattern rank, 'unknown' unit, factor 1.0 default -----------
def ipq_ranked_columns(text: Column) -> list[Column]:
    """confidence 0.9 - 0.05 * rank of the first matching pattern; unit 'count' when the
    pattern carries none; factor 1.0 for unknown units; no match: value NULL, unit 'unknown', 0."""
    low = F.lower(text)
    branches = []
    for i, (rx, groups, _implied) in enumerate(compiled_patterns()):
        first = F.regexp_extract(low, rx, 1)
        unit = F.regexp_extract(low, rx, 2) if groups > 1 else F.lit("count")
        branches.append(F.when(first != "", F.struct(first.alias("raw"), unit.alias("unit"), F.lit(i).alias("rank"))))
    hit = F.coalesce(*branches)
    value = ascii_digits(hit["raw"]).cast("double")
    factor = F.coalesce(F.try_element_at(unit_map(), hit["unit"])["factor"], F.lit(1.0))
    return [
        value.alias("ipq_value"),
        F.coalesce(hit["unit"], F.lit("unknown")).alias("ipq_unit"),
        (value * factor).alias("ipq_normalized"),
        F.when(hit.isNull(), F.lit(0.0)).otherwise(F.lit(0.9) - F.lit(0.05) * hit["rank"]).alias("ipq_confidence"),
    ]
