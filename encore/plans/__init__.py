"""Query catalogue, DuckDB oracle statements and end-to-end flows."""
