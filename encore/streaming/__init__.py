"""Incremental (Structured Streaming) form of the utility-matrix aggregation."""

from encore.streaming.utility_stream import start_incremental_utility, read_utility

__all__ = ["start_incremental_utility", "read_utility"]
