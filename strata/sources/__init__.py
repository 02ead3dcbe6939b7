"""Readers, file discovery and table sinks."""
