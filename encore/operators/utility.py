"""Sparse utility matrix (COO) and its marginal counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def utility_matrix(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                   count_col: str = "total_count") -> DataFrame:
    """``(user, item, total_count)``: interactions per pair.

    Partial aggregation combines each (user, item) inside the map task, so the
    shuffle moves at most one row per pair per task regardless of skew.
    """
    return df.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias(count_col))


def items_per_user(utility: DataFrame, user_col: str = "user_id",
                   out_col: str = "song_count_per_user") -> DataFrame:
    return utility.groupBy(user_col).agg(F.count(F.lit(1)).alias(out_col))


def users_per_item(utility: DataFrame, item_col: str = "item_id",
                   out_col: str = "user_count_per_song") -> DataFrame:
    return utility.groupBy(item_col).agg(F.count(F.lit(1)).alias(out_col))


def distinct_users(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    return df.select(user_col).distinct()
