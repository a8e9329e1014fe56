"""Registered queries: text features (F*, R*, V07, P07, J05) on the derived catalog and on documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions.ipq import unit_map
from ..oracle.fixtures import with_fixtures
from ..oracle.sqlfeatures import features_select, ipq_select, keywords, q, text_stats, word_count
from ..plans import features as FE
from ..registry import register
from ..sources.derived import catalog, documents_as_catalog


@register("f01_pack_quantity", with_fixtures(f"select * from ({ipq_select('catalog')})"))
def f01_pack_quantity(spark, sf_dir):
    """Pack quantity of every catalog text."""
    return FE.pack_quantity(catalog(spark, sf_dir))


@register("f01_pack_quantity_documents", with_fixtures(f"select * from ({ipq_select('docs')})"))
def f01_pack_quantity_documents(spark, sf_dir):
    """F01 over whole multilingual documents."""
    return FE.pack_quantity(documents_as_catalog(spark, sf_dir))


@register("f05_text_statistics", with_fixtures(
    "select sample_id, " + text_stats("_t", "_wc") +
    f" from (select sample_id, _t, {word_count('_t')} as _wc from "
    "(select sample_id, coalesce(catalog_content, '') as _t from docs))"))
def f05_text_statistics(spark, sf_dir):
    """F05-F09, F11 over whole documents."""
    return FE.text_statistics(documents_as_catalog(spark, sf_dir))


@register("f12_keywords", with_fixtures(
    "select sample_id, " + keywords("_low") + " from (select sample_id, lower(coalesce(catalog_content, '')) as _low from catalog)"))
def f12_keywords(spark, sf_dir):
    """Quality / discount keyword counts."""
    return FE.keywords(catalog(spark, sf_dir))


@register("f14_brand", with_fixtures(
    "select sample_id, has_brand, brand_position, potential_brand from (" + features_select("catalog") + ")"))
def f14_brand(spark, sf_dir):
    """F14 + R01: brand heuristic on the first five words."""
    return FE.brands(catalog(spark, sf_dir))


@register("v07_features", with_fixtures("select * from (" + features_select("catalog", keep=("price",)) + ")"))
def v07_features(spark, sf_dir):
    """The full 19-column feature row of every catalog product (one projection)."""
    return FE.engineer_features(catalog(spark, sf_dir), keep=["price"])


@register("v07_features_documents", with_fixtures("select * from (" + features_select("docs") + ")"))
def v07_features_documents(spark, sf_dir):
    """V07 over whole documents (long multilingual texts)."""
    return FE.engineer_features(documents_as_catalog(spark, sf_dir))


@register("j05_unit_lookup", with_fixtures(
    "select sample_id, ipq_unit, ipq_unit_type, ipq_normalized, ipq_normalized / u.factor as ipq_value_back "
    "from (" + ipq_select("catalog") + ") f left join (select * from (values " +
    ", ".join(f"({q(u)}, {float(fa)!r})" for u, (_t, fa) in C.UNIT_CONVERSIONS.items()) +
    ") v(unit, factor)) u on u.unit = f.ipq_unit where f.has_ipq"))
def j05_unit_lookup(spark, sf_dir):
    """Unit dimension lookup, normalisation and its inverse (round trip)."""
    f = FE.pack_quantity(catalog(spark, sf_dir)).where(F.col("has_ipq"))
    factor = F.try_element_at(unit_map(), F.col("ipq_unit"))["factor"]
    return f.select("sample_id", "ipq_unit", "ipq_unit_type", "ipq_normalized",
                    (F.col("ipq_normalized") / factor).alias("ipq_value_back"))
