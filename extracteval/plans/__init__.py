"""Query registry (Spark) and the matching DuckDB statements."""
