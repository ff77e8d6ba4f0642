"""Incremental ingest of landed JSONL batches with Structured Streaming."""
