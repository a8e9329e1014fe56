"""Synthetic catalog rows for pipeline validation, one per input id, deterministic per (seed, id).

Categories with price ranges, a log-uniform price (2 decimals), a quality word, a quantity phrase, a
product name and one of four description templates. Every random choice is an md5-derived uniform of
(seed, stream, id), so the rows do not depend on partitioning or on the order of the ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.errors import md5_uniform

# FIXED VALUES (validation catalog): categories with (min, max) price, quantity phrases, quality words,
# description templates ({c} = category in lower case, {C} = category)
CATEGORIES = [("Electronics", 100, 2000), ("Clothing", 20, 500), ("Books", 5, 100), ("Home", 30, 800), ("Sports", 15, 400)]
QUANTITIES = ["", "Pack of 2", "Pack of 3", "500g", "1kg", "250ml", "1L"]
QUALITY = ["", "Premium", "Professional", "Deluxe", "Standard"]
DESCRIPTIONS = [
    "High quality {c} item with excellent features. Best seller in {C}.",
    "Best selling {c} product with great reviews. Premium quality guaranteed.",
    "Affordable {c} solution for everyday use. Value for money product.",
    "Premium grade {c} with professional quality. Top rated by customers.",
]


def _pick(u: Column, n: int) -> Column:
    return F.least(F.floor(u * n), F.lit(n - 1)).cast("int")


def synthetic_catalog(ids: DataFrame, key: str, seed: int = 42, include_price: bool = True) -> DataFrame:
    """``(sample_id, product_name, catalog_content, category, image_link[, price])`` per id of ``ids``."""
    k = F.col(key).cast("string")
    ci = _pick(md5_uniform(k, seed, 1), len(CATEGORIES))
    qi = _pick(md5_uniform(k, seed, 3), len(QUANTITIES))
    wi = _pick(md5_uniform(k, seed, 4), len(QUALITY))
    di = _pick(md5_uniform(k, seed, 5), len(DESCRIPTIONS))
    cat = F.element_at(F.array(*[F.lit(c) for c, _, _ in CATEGORIES]), ci + 1)
    lo = F.element_at(F.array(*[F.lit(math.log(a)) for _, a, _ in CATEGORIES]), ci + 1)
    hi = F.element_at(F.array(*[F.lit(math.log(b)) for _, _, b in CATEGORIES]), ci + 1)
    raw_price = F.exp(lo + md5_uniform(k, seed, 2) * (hi - lo))
    price = F.floor(raw_price * 100 + 0.5) / 100
    qty = F.element_at(F.array(*[F.lit(q) for q in QUANTITIES]), qi + 1)
    qual = F.element_at(F.array(*[F.lit(q) for q in QUALITY]), wi + 1)
    name = F.trim(F.concat_ws(" ", qual, cat, F.lit("Product"), k, qty))
    desc = F.element_at(F.array(*[
        F.replace(F.replace(F.lit(t), F.lit("{c}"), F.lower(cat)), F.lit("{C}"), cat) for t in DESCRIPTIONS]), di + 1)
    cols = [k.alias("sample_id"), name.alias("product_name"), desc.alias("catalog_content"), cat.alias("category"),
            F.concat(F.lit("https://example.com/images/"), k, F.lit(".jpg")).alias("image_link")]
    if include_price:
        cols.append(price.alias("price"))
    return ids.select(*cols)
