"""Structured Streaming ingest into the landing table."""
