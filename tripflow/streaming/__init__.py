"""Incremental ingest of newly landed monthly files with Structured Streaming."""
