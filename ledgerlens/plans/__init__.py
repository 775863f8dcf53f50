"""The reports and jobs, the query registry and the DuckDB cross-check SQL."""
