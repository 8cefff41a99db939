"""Scalar functions as columns."""
