"""Structured Streaming: incremental file import."""
