"""Readers, writers, saved models and the session catalog."""
