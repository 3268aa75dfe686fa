"""Parquet scans of the input tables.

Scans are lazy: Catalyst prunes the columns a query does not use and pushes
simple predicates into the Parquet reader (``PushedFilters`` / ``ReadSchema``
in ``explain``).  Any Hadoop-compatible URI works as ``base``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base: str, name: str) -> str:
    base = base.rstrip("/")
    return f"{base}/{name}.parquet"


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan ``{base}/{name}.parquet``."""
    return spark.read.parquet(table_path(base, name))


def register_views(spark: SparkSession, base: str, names=TABLES) -> None:
    """Expose the scans as temp views for ``spark.sql``."""
    for name in names:
        load_table(spark, base, name).createOrReplaceTempView(name)
