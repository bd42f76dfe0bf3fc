"""Streaming forms of ingest and of the retrieval log."""
