"""Structured Streaming counts, windows and sinks."""
