"""Operators of a training-data pipeline: cleaning, deduplication, filtering and mixing of document collections."""
