"""Structured Streaming parts: incremental ingest, tier streams, windows, metrics."""
