"""Structured Streaming front end for incremental ingest."""
