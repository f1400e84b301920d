"""Structured Streaming jobs: raw landing and running totals."""
