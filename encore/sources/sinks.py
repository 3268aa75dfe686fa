"""Parquet sinks: plain overwrite, user-clustered layout, bounded export, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from encore.operators.indexing import row_index

_IDX = "__encore_idx"
_HASH = "__encore_hash"
_COPIES = "__encore_copies"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_by_user(df: DataFrame, path: str, user_col: str = "user_id", mode: str = "overwrite") -> None:
    """Cluster rows by user in the output files.

    Uses a REBALANCE hint rather than ``repartition(user)``: adaptive execution
    then splits a partition that one heavy user makes oversized and merges
    small ones, so no single writer task receives a third of the data.
    """
    df.hint("rebalance", user_col).write.mode(mode).parquet(path)


def write_bucketed_by_user(df: DataFrame, table: str, path: str, num_buckets: int,
                           user_col: str = "user_id", sort_cols: Sequence[str] = (),
                           mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a table bucketed (and optionally sorted) by user at ``path``.

    Tables bucketed on the same key with the same bucket count join and group
    on that key without a shuffle.  Each writing task writes its own files per
    bucket, so the write itself needs no shuffle and no task receives a whole
    bucket.  Returns the table as read back through the catalog.
    """
    writer = df.write.mode(mode).format("parquet").option("path", path).bucketBy(num_buckets, user_col)
    if sort_cols:
        writer = writer.sortBy(*sort_cols)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def page(df: DataFrame, order_cols: Sequence[str], offset: int, size: int | None, *,
         num_partitions: int) -> DataFrame:
    """Rows ``offset+1 .. offset+size`` in ``order_cols`` order (``size=None``: to the end).

    Only the order keys and a hash of the row are numbered (``row_index``); the
    page's keys then select the rows.  The key range of the page is pushed into
    the scan, so a source sorted by its keys is read in part only.  Rows tied on
    the keys follow in the order of their hash; fully identical rows are counted,
    so a page that ends among copies has the right number of them.
    """
    keys = list(order_cols)
    row_hash = F.xxhash64(*[F.to_json(F.struct(c)) if isinstance(f.dataType, MapType) else F.col(c)
                            for c, f in zip(df.columns, df.schema.fields, strict=True)])
    names = [f"__encore_k{k}" for k in range(len(keys))]
    narrow = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), row_hash.alias(_HASH))
    numbered = row_index(narrow, names, _IDX, num_partitions=num_partitions)
    inside = F.col(_IDX) > F.lit(offset)
    if size is not None:
        inside = inside & (F.col(_IDX) <= F.lit(offset + size))
    chosen = numbered.filter(inside).groupBy(*names, _HASH).agg(F.count(F.lit(1)).alias(_COPIES))
    first, last = chosen.agg(F.min(names[0]), F.max(names[0])).first()  # one row
    rows = df.withColumn(_HASH, row_hash)
    if first is not None and chosen.filter(F.col(names[0]).isNull()).isEmpty():
        rows = rows.filter(F.col(keys[0]).between(first, last))
    # null keys are equal to themselves here; the hash of the whole row decides
    same = F.col(_HASH) == F.col("__encore_hash2")
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    met = rows.join(chosen.withColumnRenamed(_HASH, "__encore_hash2"), same)
    maps = any(isinstance(f.dataType, MapType) for f in df.schema.fields)  # DISTINCT cannot compare maps
    one = met.dropDuplicates([_HASH, *keys]) if maps else met.select(*df.columns, _COPIES).distinct()
    return (one.withColumn("__encore_copy", F.explode(F.sequence(F.lit(1), F.col(_COPIES).cast("int"))))
               .select(*df.columns))


def bounded_export(df: DataFrame, order_cols: Sequence[str], max_rows: int, path: str | None = None,
                   mode: str = "overwrite", *, num_partitions: int) -> DataFrame:
    """The first ``max_rows`` rows in key order (a deterministic LIMIT, whatever the input's
    size); written to ``path`` and read back when given.

    Whole rows are numbered in one range shuffle: an export is a large part of its input,
    so numbering keys alone and joining the rows back (``page``) would move more.
    """
    bounded = row_index(df, order_cols, _IDX, num_partitions=num_partitions).where(F.col(_IDX) <= max_rows).drop(_IDX)
    if path is None:
        return bounded
    bounded.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(bounded.schema).parquet(path)
