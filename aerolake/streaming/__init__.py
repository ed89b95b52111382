"""Structured Streaming: incremental, exactly-once ingest of newly landed files."""
