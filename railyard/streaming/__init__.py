"""Incremental (Structured Streaming) ingest of snapshot folders."""
