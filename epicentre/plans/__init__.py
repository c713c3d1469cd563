"""Plans: the end-to-end pipeline, the query catalog and its DuckDB oracle."""
