"""Independent SQL statements of what every registered query must return, for DuckDB."""
