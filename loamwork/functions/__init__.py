"""Scalar column functions."""
