"""Incremental loads driven by Structured Streaming (file-arrival triggers)."""
