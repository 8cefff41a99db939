"""Datasets derived from packets."""
