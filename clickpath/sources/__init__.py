"""Scans, sources and sinks: declared schemas, raw NDJSON, derived Parquet, test bridge."""
