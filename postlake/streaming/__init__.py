"""Incremental landing driven by Structured Streaming."""
