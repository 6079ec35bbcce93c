"""Incremental zone synchronisation on Structured Streaming."""
