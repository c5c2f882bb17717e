"""Structured Streaming forms of the per-frame aggregates."""
