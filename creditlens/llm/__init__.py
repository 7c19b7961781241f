"""Operators of a training-data pipeline: quality, dedup, privacy, contamination, scoring, archives."""
