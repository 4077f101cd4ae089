"""Exact distinct items of streams on Structured Streaming."""
