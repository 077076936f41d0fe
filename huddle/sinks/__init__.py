"""Sinks: partitioned Parquet, CSV, text reports, incremental landing."""
