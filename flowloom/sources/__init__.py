"""Readers of packets, lines and reference tables."""
