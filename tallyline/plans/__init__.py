"""Composite plans (the feature table, the daily refresh) and the registry
of every SURVEY §2 query with its DuckDB oracle (catalog_*.py)."""
