"""Report plans (E1-E18) and the query catalog with its DuckDB oracles."""
