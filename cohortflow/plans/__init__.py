"""Pipeline composition, registered queries, DuckDB oracle SQL and size checks."""
