"""Incremental (Structured Streaming) form of the hourly demand counts."""
