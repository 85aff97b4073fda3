"""Batch/stream operators over DataFrames."""
