"""Incremental bars with Structured Streaming."""
