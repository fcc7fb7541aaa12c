"""Incremental (Structured Streaming) variants of the jobs."""
