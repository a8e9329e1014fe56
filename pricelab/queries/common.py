"""Column groups of the feature table shared by several query modules."""

from ..plans.features import FEATURE_COLUMNS

FLOAT_COLS = {"ipq_value", "ipq_normalized", "ipq_confidence", "uppercase_ratio", "avg_word_length", "brand_position", "price"}
BOOL_COLS = {"has_ipq", "has_quality_keywords", "has_discount_keywords", "has_brand"}
STRING_COLS = {"ipq_unit", "ipq_unit_type", "potential_brand"}
AUDIT_COLS = ["sample_id"] + FEATURE_COLUMNS + ["price"]
NUMERIC_COLS = [c for c in FEATURE_COLUMNS + ["price"] if c not in BOOL_COLS | STRING_COLS]
