"""Operators of a training-data pipeline: deduplication, scans, search, mixing, tokens."""
