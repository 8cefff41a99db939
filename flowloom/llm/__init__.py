"""Operators for large training-text corpora; nothing outside this package imports it."""
