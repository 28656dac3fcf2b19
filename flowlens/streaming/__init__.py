"""Structured Streaming forms of the batch aggregates (the reference itself has no streams)."""
