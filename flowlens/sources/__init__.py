"""Readers, sinks and driver-table adapters."""

from flowlens.sources.readers import read_table  # noqa: F401
