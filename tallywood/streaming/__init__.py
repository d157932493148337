"""Structured Streaming queries over frames and results."""
