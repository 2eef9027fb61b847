"""Incremental raw ingest with Structured Streaming (feeds the batch operators)."""
