"""Structured Streaming forms of ingest operators."""
