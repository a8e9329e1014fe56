"""Operators of a training-data pipeline: packing, mixing, quality rules, near and exact duplicates,
token counts, secret links and shards. Nothing else in the library imports this subpackage."""
