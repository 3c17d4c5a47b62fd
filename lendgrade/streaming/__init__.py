"""Incremental landing-zone ingestion with Structured Streaming."""
