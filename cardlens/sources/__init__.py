"""Sources (parquet tables, benchmark-table adapters) and sinks."""
