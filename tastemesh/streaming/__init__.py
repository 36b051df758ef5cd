"""Structured Streaming ingest of review documents."""
