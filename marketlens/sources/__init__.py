"""Sources (CSV/Parquet extracts, test-data adapter) and sinks."""
