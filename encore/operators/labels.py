"""Per-user ranked label lists (the "actual songs" of the evaluation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_lists(utility: DataFrame, k: int | None = 100, user_col: str = "user_id",
                item_col: str = "item_id", count_col: str = "total_count",
                rank_col: str = "label_rank") -> DataFrame:
    """Each user's top-k items, exploded: ``(user, item, label_rank)``.

    Order: larger ``total_count`` first, equal counts by the larger item id.
    ``row_number() <= k`` is planned with a partial window-group limit, so no
    task ever holds more than k rows of one user — unlike collecting a user's
    whole history into an array and slicing it.  (With ``k=None`` every pair is
    ranked; metrics that need no rank can take the utility pairs directly.)
    """
    w = Window.partitionBy(user_col).orderBy(F.col(count_col).desc(), F.col(item_col).desc())
    ranked = utility.select(user_col, item_col, count_col).withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col(rank_col) <= k)
    return ranked.select(user_col, item_col, rank_col)


def label_arrays(labels: DataFrame, k: int, user_col: str = "user_id", item_col: str = "item_id",
                 rank_col: str = "label_rank", out_col: str = "actual_songs") -> DataFrame:
    """``(user, ARRAY<item>)`` in rank order from the exploded form.

    Ranks above ``k`` are cut before collecting, so an array never holds more
    than k items whatever the size of a user's history.
    """
    labels = labels.filter(F.col(rank_col) <= k)
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(item_col).alias("i"))))
    return labels.groupBy(user_col).agg(F.transform(pairs, lambda s: s["i"]).alias(out_col))


def explode_lists(lists: DataFrame, list_col: str, user_col: str = "user_id",
                  item_col: str = "item_id", rank_col: str = "rank") -> DataFrame:
    """``(user, ARRAY<item>)`` -> ``(user, item, rank)`` with a 1-based rank."""
    return (lists.select(user_col, F.posexplode(list_col).alias("__pos", item_col))
                 .select(user_col, item_col, (F.col("__pos") + 1).cast("int").alias(rank_col)))
