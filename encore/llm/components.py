"""Connected components of an undirected graph given as an edge table.

Alternating star contraction: every node's larger neighbours are hung on the smallest
node it knows, then every node and its smaller neighbours on the smallest of them,
until nothing changes.  Each half round is a partial aggregation and a join, and its
edges are written to the shared folder before the next one; the number of edges never
grows.  Nothing is collected but one row of two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.sources.scratch import materialize, release


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of each node and its neighbours; a table of its own, so that
    joins with it have plain exchanges, which adaptive execution can split for a hot node."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "cc-smallest")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of an edge ``(u, v)``.

    Loops, repeated and reversed edges may occur; nulls are ignored.
    """
    pair = lambda a, b: F.struct(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = materialize(edges.select(pair(F.col("u"), F.col("v")).alias("e")).select("e.u", "e.v").distinct(), "cc-edges")
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _smallest(both)
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                                .where("u <> v").distinct(), "cc-large")
        release(now, low)
        low = _smallest(large)  # all edges point to a smaller node
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = materialize(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "cc-edges")
        release(large, low)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
