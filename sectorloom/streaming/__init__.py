"""Incremental refreshes with Structured Streaming."""
