"""Incremental (new-files-only) ingestion with Structured Streaming."""
