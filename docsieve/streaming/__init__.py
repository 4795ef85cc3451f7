"""Continuous indexing and live counters on Structured Streaming."""
