"""Popularity recommenders: damped mean, weighted product, and a beta sweep.

All forms start from one aggregate per item, ``(sum(total_count), n_users)``,
computed from the utility matrix with partial aggregation.  The top-k cut is a
``TakeOrderedAndProject`` (each task keeps its local top-k; only those rows
move), with the item id as an explicit tie-break so the list is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.columns import damped_mean, weighted_popularity


def item_stats(utility: DataFrame, item_col: str = "item_id",
               count_col: str = "total_count") -> DataFrame:
    """``(item, total, n_users)`` per item of a utility matrix."""
    return utility.groupBy(item_col).agg(
        F.sum(count_col).alias("total"),
        F.count(count_col).alias("n_users"),
    )


def popularity(utility: DataFrame, measure: str = "damped", beta: float = 0,
               item_col: str = "item_id", count_col: str = "total_count") -> DataFrame:
    """``(item, popularity)``.

    * ``damped``:   sum / (n_users + beta)  (DOUBLE)
    * ``weighted``: sum * (n_users + beta)  (DECIMAL for a whole beta, else DOUBLE; beta 0 = sum * n)
    """
    stats = item_stats(utility, item_col, count_col)
    if measure == "damped":
        score = damped_mean(F.col("total"), F.col("n_users"), beta)
    elif measure == "weighted":
        score = weighted_popularity(F.col("total"), F.col("n_users"), beta)
    else:
        raise ValueError("measure must be 'damped' or 'weighted'")
    return stats.select(item_col, score.alias("popularity"))


def top_k(scores: DataFrame, k: int = 100, item_col: str = "item_id",
          score_col: str = "popularity", rank_col: str = "rank") -> DataFrame:
    """The k best items, ``rank`` 1..k, ties broken by the smaller item id."""
    order = [F.col(score_col).desc(), F.col(item_col).asc()]
    best = scores.orderBy(*order).limit(k)
    # the window runs over at most k rows
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def popularity_top_k(utility: DataFrame, k: int = 100, measure: str = "damped", beta: float = 0,
                     item_col: str = "item_id", count_col: str = "total_count") -> DataFrame:
    return top_k(popularity(utility, measure, beta, item_col, count_col), k, item_col)


def beta_sweep_top_k(utility: DataFrame, betas: Sequence[float], k: int = 100,
                     measure: str = "damped", item_col: str = "item_id",
                     count_col: str = "total_count") -> DataFrame:
    """Top-k per beta in one pass: ``(beta, item, popularity, rank)``.

    Item statistics are computed once; each item row is expanded to one row per
    beta with ``explode`` (no join); ``row_number() <= k`` per beta is planned
    with a partial window-group limit before the shuffle, so each task sends at
    most k rows per beta.
    """
    if any(b < 0 for b in betas):
        raise ValueError("beta must be >= 0")
    if measure not in ("damped", "weighted"):
        raise ValueError("measure must be 'damped' or 'weighted'")
    # exact integers while every beta of the sweep is whole, as in the single form
    whole = measure == "weighted" and all(float(b).is_integer() for b in betas)
    stats = item_stats(utility, item_col, count_col)
    grid = F.explode(F.array(*[F.lit(int(b)).cast("long") if whole else F.lit(float(b)) for b in betas]))
    expanded = stats.select(item_col, "total", "n_users", grid.alias("beta"))
    listeners = F.col("n_users") + F.col("beta")
    if measure == "damped":
        score = F.col("total") / listeners
    elif whole:
        score = F.col("total").cast("decimal(20,0)") * listeners.cast("decimal(17,0)")
    else:
        score = F.col("total").cast("double") * listeners
    scored = expanded.select("beta", item_col, score.alias("popularity"))
    w = Window.partitionBy("beta").orderBy(F.col("popularity").desc(), F.col(item_col).asc())
    return (scored.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= k))


def ranked_list(top: DataFrame, item_col: str = "item_id", rank_col: str = "rank",
                out_col: str = "popular_songs", group_cols: Sequence[str] = ()) -> DataFrame:
    """The top-k as one ``ARRAY<item>`` row per group, in rank order.

    Replaces collecting the list to the driver; the array holds at most k
    items, so the single output row is bounded by k.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(item_col).alias("i"))))
    return top.groupBy(*group_cols).agg(F.transform(pairs, lambda s: s["i"]).alias(out_col))
