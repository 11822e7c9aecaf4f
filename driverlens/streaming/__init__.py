"""Incremental runs as Structured Streaming queries."""
