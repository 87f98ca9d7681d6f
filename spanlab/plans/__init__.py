"""The registered query catalogue (Spark callables and their DuckDB oracle SQL)."""
