"""Interaction, catalogue and null-injected views over the input tables.

* sales interactions: one row per order line (customer listens to a part);
  almost every (user, item) pair occurs once — a sparse utility matrix.
* event interactions: ``events`` rows, the item is the ``k`` field of the JSON
  ``props`` column; counts per (user, item) vary — a dense utility matrix.
* track catalogue: ``part`` with a string natural key, like a track table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.tables import load_table


def sales_interactions(spark: SparkSession, base: str) -> DataFrame:
    orders = load_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = load_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
    )


def sales_interactions_with_nulls(spark: SparkSession, base: str) -> DataFrame:
    """Sales interactions with nulls injected into the keys (fixed rule on the supplier)."""
    orders = load_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = load_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(F.col("l_suppkey") % 15 == 0, F.lit(None)).otherwise(F.col("l_partkey")).alias("item_id"),
        F.col("o_orderdate").alias("ts"),
    )


#: Added to an item's key to give a key that no catalogue row has.
ORPHAN_SHIFT = 1_000_000_000


def sales_interactions_raw(spark: SparkSession, base: str) -> DataFrame:
    """Sales interactions as they might arrive: null users and items (fixed rules on the
    supplier) and items that the catalogue does not have (every seventh part key)."""
    orders = load_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = load_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    item = F.when(F.col("l_partkey") % 7 == 0, F.col("l_partkey") + F.lit(ORPHAN_SHIFT)).otherwise(F.col("l_partkey"))
    return joined.select(
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(F.col("l_suppkey") % 15 == 0, F.lit(None)).otherwise(item).alias("item_id"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
    )


def event_interactions(spark: SparkSession, base: str) -> DataFrame:
    events = load_table(spark, base, "events")
    return events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        "ts",
        "event_id",
    )


def track_catalogue(spark: SparkSession, base: str) -> DataFrame:
    part = load_table(spark, base, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("recording_msid"),
        "p_name", "p_brand", "p_size",
    )
