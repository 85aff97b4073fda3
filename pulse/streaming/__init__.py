"""Micro-batch jobs, idempotent sinks and keyed state."""
