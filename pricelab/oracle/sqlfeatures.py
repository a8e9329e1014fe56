"""SQL (DuckDB dialect) text for the feature definitions, used by the oracle side of the
correctness check. Built from the same fixed values and the same Python-equivalent character
classes as the Spark expressions, but evaluated by a different engine (RE2, DuckDB functions).
"""

from __future__ import annotations

from .. import constants as C
from ..functions.charclass import ALPHA_CLASS, UPPER_CLASS, alnum_or_ws_class, decimal_digit_map, digit_class, non_ws_class, ws_class
from ..functions.ipq import compiled_patterns


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def count_class(t: str, cls: str) -> str:
    return f"(length({t}) - length(regexp_replace({t}, {q(cls)}, '', 'g')))"


def word_count(t: str) -> str:
    return f"len(regexp_extract_all({t}, {q(non_ws_class() + '+')}))"


def text_stats(t: str, wc: str) -> str:
    """Six columns; ``t`` is the cleaned text, ``wc`` its word count (both SQL expressions)."""
    n = f"length({t})"
    letters = count_class(t, ALPHA_CLASS)
    upper = count_class(t, UPPER_CLASS)
    spaces = count_class(t, ws_class())
    return ",\n".join([
        f"CAST({n} AS BIGINT) AS text_length",
        f"CAST({wc} AS BIGINT) AS word_count",
        f"CAST({count_class(t, digit_class())} AS BIGINT) AS digit_count",
        f"CAST(length(regexp_replace({t}, {q(alnum_or_ws_class())}, '', 'g')) AS BIGINT) AS special_char_count",
        f"CASE WHEN {letters} > 0 THEN CAST({upper} AS DOUBLE) / {letters} ELSE 0.0 END AS uppercase_ratio",
        f"CASE WHEN {wc} > 0 THEN CAST({n} - {spaces} AS DOUBLE) / {wc} ELSE 0.0 END AS avg_word_length",
    ])


def keyword_count(low: str, words: list[str]) -> str:
    return "CAST((" + " + ".join(f"(CASE WHEN instr({low}, {q(k)}) > 0 THEN 1 ELSE 0 END)" for k in words) + ") AS BIGINT)"


def keywords(low: str) -> str:
    qc = keyword_count(low, C.QUALITY_KEYWORDS)
    dc = keyword_count(low, C.DISCOUNT_KEYWORDS)
    return ",\n".join([
        f"{qc} > 0 AS has_quality_keywords", f"{qc} AS quality_keyword_count",
        f"{dc} > 0 AS has_discount_keywords", f"{dc} AS discount_keyword_count",
    ])


def ipq_raw_unit(low: str) -> tuple[str, str]:
    """(raw number text, unit) CASE ladders over the ordered patterns."""
    raw, unit = [], []
    for rx, groups, implied in compiled_patterns():
        g1 = f"regexp_extract({low}, {q(rx)}, 1)"
        raw.append(f"WHEN {g1} <> '' THEN {g1}")
        u = f"regexp_extract({low}, {q(rx)}, 2)" if groups > 1 else q(implied)
        unit.append(f"WHEN {g1} <> '' THEN {u}")
    return "CASE " + " ".join(raw) + " END", "CASE " + " ".join(unit) + " END"


def unit_values() -> str:
    rows = ", ".join(f"({q(u)}, {q(t)}, {float(f)!r})" for u, (t, f) in C.UNIT_CONVERSIONS.items())
    return f"(VALUES {rows}) AS units(unit, unit_type, factor)"


def ascii_digits(x: str) -> str:
    src, dst = decimal_digit_map()
    return f"translate({x}, {q(src)}, {q(dst)})"


def ipq_select(src: str, id_col: str = "sample_id", text_col: str = "catalog_content", extra: str = "") -> str:
    """SELECT producing id + six pack-quantity columns from relation ``src``."""
    low = "lower(coalesce(" + text_col + ", ''))"
    raw, unit = ipq_raw_unit("_low")
    return f"""
    SELECT m.{id_col}{extra},
      CAST({ascii_digits('m._raw')} AS DOUBLE) AS ipq_value,
      m._unit AS ipq_unit,
      CAST({ascii_digits('m._raw')} AS DOUBLE) * units.factor AS ipq_normalized,
      units.unit_type AS ipq_unit_type,
      CASE WHEN m._raw IS NULL THEN 0.0 WHEN units.unit IS NOT NULL THEN 0.9 ELSE 0.7 END AS ipq_confidence,
      m._raw IS NOT NULL AS has_ipq
    FROM (SELECT *, {raw} AS _raw, {unit} AS _unit FROM (SELECT *, {low} AS _low FROM {src})) m
    LEFT JOIN {unit_values()} ON units.unit = m._unit
    """


def brand(t: str, wc: str) -> str:
    ws = ws_class()
    words5 = f"string_split_regex(regexp_replace({t}, {q('^' + ws + '+')}, ''), {q(ws + '+')})[1:5]"
    hits = (f"list_filter(list_transform({words5}, lambda w, i: {{'w': w, 'i': i}}), "
            f"lambda x: regexp_matches(regexp_replace(x.w, '[^a-zA-Z]', '', 'g'), '^[A-Z]([A-Z]+|[a-z]+)$'))[1]")
    ok = f"(({hits}) IS NOT NULL AND {wc} > 0)"
    return ",\n".join([
        f"coalesce({ok}, false) AS has_brand",
        f"CASE WHEN {ok} THEN CAST(({hits}).i - 1 AS DOUBLE) / {wc} END AS brand_position",
        f"CASE WHEN {ok} THEN ({hits}).w END AS potential_brand",
    ])


def features_select(src: str, id_col: str = "sample_id", text_col: str = "catalog_content", keep: tuple[str, ...] = ()) -> str:
    """The full 19-column feature row (V07) in SQL."""
    extra = "".join(f", {k}" for k in keep)
    ipq = ipq_select(src, id_col, text_col, extra)
    t = "_t"
    wc = "_wc"
    kc = "".join(f", f.{k}" for k in keep)
    return f"""
    WITH base AS (SELECT {id_col}{extra}, coalesce({text_col}, '') AS _t, lower(coalesce({text_col}, '')) AS _low FROM {src}),
    b2 AS (SELECT *, {word_count('_t')} AS _wc FROM base),
    ipq AS ({ipq})
    SELECT f.{id_col}{kc}, ipq.ipq_value, ipq.ipq_unit, ipq.ipq_normalized, ipq.ipq_unit_type, ipq.ipq_confidence, ipq.has_ipq,
      {text_stats(t, wc)},
      {keywords('_low')},
      {brand(t, wc)}
    FROM b2 f JOIN ipq ON ipq.{id_col} = f.{id_col}
    """
