"""Structured Streaming variants of the stateful datasets."""
