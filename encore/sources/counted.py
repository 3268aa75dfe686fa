"""Counts of stages taken while their tables are written, instead of by further passes.

``write_counted`` writes a frame and observes aggregates of the very rows that are written.  The
observation sits in the writing stage itself: its tasks count once each, however often an
executor is lost and a task is run again (metrics observed before a shuffle could count
a repeated map task twice, so nothing is observed there).

``prepare_counted`` is the preparation from raw interactions to utility matrices with every
stage counted this way.  Stages that end inside a shuffle are counted behind it: whole-row
groups carry their number of copies, so the rows before de-duplication are a sum.

A task's memory must not follow the input: rows are dealt out by all their columns before they
are grouped (they are mostly distinct, so a map-side table of them would hold a whole scan
split), and ``small_shuffles`` deals every shuffle out finely and lets adaptive execution merge
parts only up to ``PART_BYTES``.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from encore.operators.split import tag_split
from encore.sources.scratch import materialize

_COPIES = "__encore_copies"

#: Parts that every shuffle is dealt out to at least, and the bytes up to which they are merged again.
PARTS = 1024
PART_BYTES = 16 << 20


@contextlib.contextmanager
def small_shuffles(spark: SparkSession, parts: int = PARTS, part_bytes: int = PART_BYTES) -> Iterator[None]:
    """While it is open, shuffles start with ``parts`` partitions or more and are merged up to ``part_bytes``, which
    is also what a task scans: a shuffle of so many partitions is sorted in the memory of the writing task."""
    first, most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    scan = "spark.sql.files.maxPartitionBytes"
    before = {key: spark.conf.get(key, None) for key in (first, most, scan)}
    spark.conf.set(first, str(max(parts, int(before[first] or spark.conf.get("spark.sql.shuffle.partitions")))))
    spark.conf.set(most, str(part_bytes))
    spark.conf.set(scan, str(part_bytes))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_counted(df: DataFrame, name: str, metrics: Mapping[str, Column], keep: Column | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` (of it, the rows where ``keep``) as an intermediate table and return it with the
    ``metrics`` of all rows of ``df``, from the same pass; metrics over no rows follow their aggregates (0, null)."""
    seen = Observation(name)
    observed = df.observe(seen, *(c.alias(k) for k, c in metrics.items()))
    table = materialize(observed if keep is None else observed.where(keep), name)
    return table, dict(seen.get)


def prepare_counted(interactions: DataFrame, split_keys: Sequence[str], frac: float = 0.8, user_col: str = "user_id",
                    item_col: str = "item_id") -> tuple[dict[str, DataFrame], DataFrame]:
    """De-duplicated, split and aggregated interactions, and the rows of every stage.

    Returns the tables ``split`` (with ``is_train``) and ``utility`` (both sides), and a frame with
    ``stage_order``, ``stage`` and ``n_rows``: raw, non_null (no null key), deduplicated, train, val,
    utility_train, utility_val.  The source is scanned once.
    """
    zero = F.lit(0).cast("long")
    total = lambda c, when=None: F.coalesce(F.sum(c if when is None else F.when(when, c)), zero)
    whole = F.col(user_col).isNotNull() & F.col(item_col).isNotNull()
    dealt = interactions.repartition(*interactions.columns)
    copies = dealt.groupBy(*interactions.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    with small_shuffles(interactions.sparkSession):
        clean, a = write_counted(copies, "counted-clean", {
            "raw": total(F.col(_COPIES)), "non_null": total(F.col(_COPIES), whole), "deduplicated": F.count(F.when(whole, 1))}, keep=whole)
        side = F.col("is_train")
        tagged, b = write_counted(tag_split(clean.drop(_COPIES), user_col, split_keys, frac), "counted-split",
                                  {"train": F.count(F.when(side, 1)), "val": F.count(F.when(~side, 1))})
        utility, c = write_counted(tagged.groupBy(user_col, item_col, "is_train").agg(F.count(F.lit(1)).alias("total_count")), "counted-utility",
                                   {"utility_train": F.count(F.when(side, 1)), "utility_val": F.count(F.when(~side, 1))})
    rows = [(n, stage, int(count)) for n, (stage, count) in enumerate((a | b | c).items())]
    counts = interactions.sparkSession.createDataFrame(rows, "stage_order int, stage string, n_rows long")
    return {"split": tagged, "utility": utility}, counts
