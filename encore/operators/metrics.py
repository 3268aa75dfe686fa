"""Ranking metrics at k — MAP, NDCG (binary relevance) and precision.

Definitions (for one user, predictions p ranked 1.., label set L, h_r = 1 when
the item at rank r is in L; they agree with Spark ML's ``RankingMetrics``):

* AP@k   = sum_{r <= k, h_r} (hits among ranks <= r) / r  /  min(|L|, k)
* NDCG@k = sum_{r <= k, h_r} 1 / ln(r + 1)  /  sum_{j < min(|L|, k)} 1 / ln(j + 2)
* P@k    = (hits among ranks <= k) / k
* an empty L scores 0 and the user still counts; the result is the mean over users.

Computed as DataFrames, never through an RDD or the driver: predictions and
labels meet in an equi-join on (user, item) — only hits survive it — and each
user's hit ranks (at most k values) are folded with array higher-order
functions inside one grouped aggregate.  When every user gets the same list
(popularity), the list (at most k rows per group, a proven bound) is broadcast
and joined on the item alone, so the per-user copies of the list never exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.columns import ideal_dcg


def _per_user_terms(hits: DataFrame, label_sizes: DataFrame, k: int, keys: list[str],
                    user_col: str, rank_col: str) -> DataFrame:
    ranks = F.array_sort(F.collect_list(F.col(rank_col).cast("double")))
    per_user = hits.groupBy(*keys).agg(ranks.alias("__r"))
    ap_sum = F.aggregate(
        F.sequence(F.lit(1), F.size("__r")),
        F.lit(0.0).cast("double"),
        lambda acc, i: acc + i.cast("double") / F.element_at(F.col("__r"), i),
    )
    dcg = F.aggregate(F.col("__r"), F.lit(0.0).cast("double"),
                      lambda acc, r: acc + F.lit(1.0) / F.log(r + F.lit(1.0)))
    m = F.least(F.col("__L"), F.lit(k))
    return (per_user.join(label_sizes, user_col)
            .select(*keys,
                    (ap_sum / m).alias("__ap"),
                    (dcg / ideal_dcg(m)).alias("__ndcg"),
                    (F.size("__r").cast("double") / F.lit(float(k))).alias("__p")))


def _finish(terms: DataFrame, n_users: DataFrame, group_cols: list[str]) -> DataFrame:
    sums = terms.groupBy(*group_cols).agg(
        F.sum("__ap").alias("__sap"), F.sum("__ndcg").alias("__sndcg"), F.sum("__p").alias("__sp"))
    if group_cols:
        out = n_users.join(sums, group_cols, "left")
    else:
        out = sums.select("__sap", "__sndcg", "__sp",
                          n_users.select(F.first("n_users")).scalar().alias("n_users"))
    n = F.col("n_users").cast("double")
    safe = F.when(F.col("n_users") > 0, n)
    return out.select(
        *group_cols,
        F.coalesce(F.col("__sap") / safe, F.lit(0.0)).alias("map_at_k"),
        F.coalesce(F.col("__sndcg") / safe, F.lit(0.0)).alias("ndcg_at_k"),
        F.coalesce(F.col("__sp") / safe, F.lit(0.0)).alias("precision_at_k"),
        F.col("n_users").cast("long").alias("n_users"),
    )


def label_sizes(labels: DataFrame, user_col: str = "user_id") -> DataFrame:
    return labels.groupBy(user_col).agg(F.count(F.lit(1)).alias("__L"))


def ranking_metrics(predictions: DataFrame, labels: DataFrame, k: int = 100,
                    users: str = "recommended", group_cols: Sequence[str] = (),
                    user_col: str = "user_id", item_col: str = "item_id",
                    rank_col: str = "rank") -> DataFrame:
    """Metrics of per-user ranked lists.

    ``predictions``: ``(group..., user, item, rank)`` (rank 1-based, no
    duplicate item per user); ``labels``: ``(user, item)`` — already cut to the
    label length.  ``users='recommended'`` averages over the users that have
    predictions (labels missing -> 0); ``users='all'`` over users having labels.
    Returns one row per group: ``map_at_k, ndcg_at_k, precision_at_k, n_users``.
    """
    groups = list(group_cols)
    preds = predictions.filter(F.col(rank_col) <= k).select(*groups, user_col, item_col, rank_col)
    hits = preds.join(labels.select(user_col, item_col), [user_col, item_col])
    if users == "all":
        hits = hits.join(labels.select(user_col).distinct(), user_col, "left_semi")
    terms = _per_user_terms(hits, label_sizes(labels, user_col), k, groups + [user_col],
                            user_col, rank_col)
    if users == "recommended":
        n_users = predictions.select(*groups, user_col).distinct().groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n_users"))
    elif users == "all":
        n_lab = label_sizes(labels, user_col).agg(F.count(F.lit(1)).alias("n_users"))
        if groups:
            n_users = predictions.select(*groups).distinct().withColumn(
                "n_users", n_lab.select("n_users").scalar())
        else:
            n_users = n_lab
    else:
        raise ValueError("users must be 'recommended' or 'all'")
    return _finish(terms, n_users, groups)


def shared_list_metrics(top: DataFrame, labels: DataFrame, k: int = 100,
                        group_cols: Sequence[str] = (), user_col: str = "user_id",
                        item_col: str = "item_id", rank_col: str = "rank") -> DataFrame:
    """Metrics when every labelled user receives the same list ``top``.

    ``top``: ``(group..., item, rank)``, at most k rows per group.  It is broadcast: its
    size is k times the number of groups, both given by the caller and not by the data
    (a group is one parameter value, such as a beta of a sweep).  Averages
    over all users having labels (the popularity baseline's population).
    """
    groups = list(group_cols)
    lst = top.filter(F.col(rank_col) <= k).select(*groups, item_col, rank_col)
    hits = labels.select(user_col, item_col).join(F.broadcast(lst), item_col)
    terms = _per_user_terms(hits, label_sizes(labels, user_col), k, groups + [user_col],
                            user_col, rank_col)
    # the same aggregate the terms are joined with, so its shuffle is shared
    n_lab = label_sizes(labels, user_col).agg(F.count(F.lit(1)).alias("n_users"))
    if groups:
        n_users = lst.select(*groups).distinct().withColumn("n_users", n_lab.select("n_users").scalar())
    else:
        n_users = n_lab
    return _finish(terms, n_users, groups)
