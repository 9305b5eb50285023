"""Named queries (Spark plan + DuckDB oracle text) and end-to-end workflows."""
