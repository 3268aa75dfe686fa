"""Checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is, so that
    Spark shuffles.  ``df`` should be a written table: counting it reads file footers only."""
    return F.broadcast(df) if df.count() <= max_rows else df
