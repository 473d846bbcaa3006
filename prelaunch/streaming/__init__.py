"""Structured Streaming forms of the batch operators (incremental scoring and profiling)."""
