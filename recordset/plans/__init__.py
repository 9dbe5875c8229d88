"""The query catalogue: Spark builders with DuckDB oracles over the driver tables."""
