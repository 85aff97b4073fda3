"""Operators of a training-data pipeline: deduplication, extraction, scoring, encoding, archives."""
