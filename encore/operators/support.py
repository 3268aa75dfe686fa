"""Minimum-support filters on items (and the warm-start membership filter)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_support(df: DataFrame, item_col: str = "item_id", out_col: str = "support") -> DataFrame:
    """Rows per item; on a utility matrix that is the number of distinct users."""
    return df.groupBy(item_col).agg(F.count(F.lit(1)).alias(out_col))


def min_support(df: DataFrame, threshold: int, scope: str = "self",
                reference: DataFrame | None = None, item_col: str = "item_id") -> DataFrame:
    """Keep rows whose item has support strictly greater than ``threshold``.

    ``scope='self'`` counts support on ``df`` itself (the original rule for
    both train and validation); ``scope='train'`` counts it on ``reference``.

    Planned as aggregate (partial + final, skew-proof) + semi-join instead of a
    ``count(*) OVER (PARTITION BY item)`` window, which would buffer a hot
    item's rows in a single task.  The kept-item set is broadcast only when its
    runtime size passes the broadcast threshold; otherwise the semi-join
    sort-merges and adaptive execution splits skewed partitions.
    """
    if scope == "self":
        base = df
    elif scope == "train":
        if reference is None:
            raise ValueError("scope='train' needs the reference frame")
        base = reference
    else:
        raise ValueError("scope must be 'self' or 'train'")
    keep = (item_support(base, item_col).filter(F.col("support") > F.lit(threshold))
            .select(F.col(item_col).alias("__encore_item")))
    # null-safe: a NULL item is one group, as in the window formulation
    cond = F.col(item_col).eqNullSafe(F.col("__encore_item"))
    return df.join(keep, cond, "left_semi").select(*df.columns)


def warm_start_filter(df: DataFrame, train: DataFrame, user_col: str = "user_id",
                      item_col: str = "item_id") -> DataFrame:
    """Keep rows whose user and whose item both occur in ``train``."""
    users = train.select(user_col).distinct()
    items = train.select(item_col).distinct()
    return (df.join(users, user_col, "left_semi").join(items, item_col, "left_semi")
              .select(*df.columns))
