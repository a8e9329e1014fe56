"""SQL text (DuckDB dialect) for the oracle side of the correctness check."""
