"""Approximate distinct counts as sketch columns that merge.

``sketch_parts`` keeps, for every part of a table (a day, a file, a split side), HyperLogLog
sketches of its key columns beside its row count: some kilobytes a part, stored once.
Any later question about a union of parts is answered from the stored sketches
(``merge_sketches``), never from the rows again.  Sketching is a partial aggregate, so a hot
key or part costs one sketch per task in the shuffle.

Edge cases: null keys are not counted; a part without a non-null key has the estimate 0; null
parts are a part; merging no sketches gives no rows, or estimates of 0 without groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-two logarithm of the number of registers of a sketch.
LG_K = 14


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The share by which an estimate may miss the truth, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def sketch_parts(df: DataFrame, part_cols: Sequence[str], key_cols: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``part_cols``, ``n_rows`` and a sketch column ``sketch_<key>`` per key."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"sketch_{c}") for c in key_cols]
    return df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def merge_sketches(parts: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """``group_cols``, ``n_rows`` and ``approx_<key>`` of the parts of each group taken together."""
    merged = [F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in key_cols]
    out = parts.groupBy(*group_cols).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), *merged)
    estimates = [F.coalesce(F.hll_sketch_estimate(f"sketch_{c}"), F.lit(0)).alias(f"approx_{c}") for c in key_cols]
    return out.select(*group_cols, "n_rows", *estimates)
