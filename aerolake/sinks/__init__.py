"""Sinks: processed/rejected Parquet writers and the curated (merge) table."""
