"""Implicit-feedback ALS through Spark ML: fit, recommend, evaluate, grid.

Spark's ALS is itself a distributed block solver; the only extra care here is
the INT id contract (cast with overflow raising), dropping null ids before the
fit, persisting the training frame across a grid, and checkpointing the factor
lineage into the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.als_solution import normal_residuals
from encore.operators.labels import explode_lists
from encore.operators.metrics import ranking_metrics
from encore.session import ensure_checkpoint_dir
from encore.sources.scratch import materialize, release


def prepare_ratings(utility: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                    rating_col: str = "total_count") -> DataFrame:
    """INT ids (ANSI cast raises on overflow), FLOAT rating, null ids dropped."""
    return (utility.dropna(subset=[user_col, item_col])
                   .select(F.col(user_col).cast("int").alias(user_col),
                           F.col(item_col).cast("int").alias(item_col),
                           F.col(rating_col).cast("float").alias(rating_col)))


def build_als(rank: int = 40, reg: float = 0.2, alpha: float = 1.0, max_iter: int = 10,
              *, seed: int, num_blocks: int, user_col: str = "user_id", item_col: str = "item_id",
              rating_col: str = "total_count", cold_start: str = "drop",
              checkpoint_interval: int = 10) -> ALS:
    return ALS(rank=rank, regParam=reg, alpha=alpha, maxIter=max_iter, seed=seed,
               numUserBlocks=int(num_blocks), numItemBlocks=int(num_blocks),
               userCol=user_col, itemCol=item_col, ratingCol=rating_col,
               implicitPrefs=True, coldStartStrategy=cold_start,
               checkpointInterval=checkpoint_interval,
               intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK")


def fit_als(utility: DataFrame, rank: int = 40, reg: float = 0.2, alpha: float = 1.0,
            max_iter: int = 10, *, seed: int, num_blocks: int, user_col: str = "user_id",
            item_col: str = "item_id", rating_col: str = "total_count") -> ALSModel:
    """Fit implicit ALS.

    The solver draws its first factors block by block, so a fit is reproduced by
    equal ``seed`` *and* equal ``num_blocks``; both are required and neither is
    derived from the cluster.  A good ``num_blocks`` is at least the cores in use
    and at least the ratings divided by some 50 million (a block's ratings are held
    in memory by one task); more blocks mean more factor exchange between them.
    """
    ensure_checkpoint_dir(utility.sparkSession)
    ratings = prepare_ratings(utility, user_col, item_col, rating_col)
    return build_als(rank, reg, alpha, max_iter, seed=seed, num_blocks=num_blocks, user_col=user_col,
                     item_col=item_col, rating_col=rating_col).fit(ratings)


def recommend(model: ALSModel, users: DataFrame | None, k: int = 100,
              user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Exploded top-k ``(user, item, rank, rating)``; ``users=None`` = all users.

    Users unknown to the model get no rows (``recommendForUserSubset``).
    """
    if users is None:
        recs = model.recommendForAllUsers(k)
    else:
        subset = users.select(F.col(user_col).cast("int").alias(user_col)).distinct()
        recs = model.recommendForUserSubset(subset, k)
    exploded = recs.select(user_col, F.posexplode("recommendations").alias("__pos", "__rec"))
    return exploded.select(
        user_col,
        F.col("__rec")[item_col].alias(item_col),
        (F.col("__pos") + 1).cast("int").alias("rank"),
        F.col("__rec")["rating"].alias("rating"),
    )


def recommendation_lists(recs: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                         out_col: str = "song_id") -> DataFrame:
    """``(user, ARRAY<item>)`` from exploded recommendations (at most k per user)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("r"), F.col(item_col).alias("i"))))
    return recs.groupBy(user_col).agg(F.transform(ordered, lambda s: s["i"]).alias(out_col))


def evaluate_als(model: ALSModel, eval_users: DataFrame, labels: DataFrame, k: int = 100,
                 user_col: str = "user_id", item_col: str = "item_id", recs: DataFrame | None = None) -> DataFrame:
    """MAP / NDCG / precision at k over the users the model recommends to.

    ``recs``: the same model's, users' and k's ``recommend`` rows, where the caller keeps them.
    """
    if recs is None:
        recs = recommend(model, eval_users, k, user_col, item_col)
    lab = labels.select(F.col(user_col).cast("int").alias(user_col),
                        F.col(item_col).cast("int").alias(item_col))
    return ranking_metrics(recs, lab, k, users="recommended", user_col=user_col, item_col=item_col)


def als_grid(train: DataFrame, eval_users: DataFrame, labels: DataFrame,
             ranks: Iterable[int], regs: Iterable[float], alphas: Iterable[float],
             k: int = 100, max_iter: int = 10, *, seed: int, num_blocks: int, user_col: str = "user_id",
             item_col: str = "item_id", rating_col: str = "total_count") -> DataFrame:
    """One metrics row per (rank, reg, alpha).

    Ratings and evaluation users are persisted, labels written, once for all fits.  Each
    model is scored as soon as it is fitted, from recommendations that are written once as the
    metrics read them twice; its users' factors are held against their normal equations
    (``max_residual``, see ``als_solution``), and its factors and recommendations are released
    before the next fit; only its one row of numbers stays.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    shared = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in (
        prepare_ratings(train, user_col, item_col, rating_col), eval_users.select(user_col).distinct())]
    ratings, users = shared
    labels = materialize(labels, "als-labels")
    rows = []
    try:
        for f in shared:
            f.count()  # fills the cache, so that what a fit adds to it can be told apart
        for rank, reg, alpha in itertools.product(ranks, regs, alphas):
            before = set(spark.sparkContext._jsc.getPersistentRDDs())
            model = build_als(rank, reg, alpha, max_iter, seed=seed, num_blocks=num_blocks, user_col=user_col,
                              item_col=item_col, rating_col=rating_col).fit(ratings)
            recs = materialize(recommend(model, users, k, user_col, item_col), "als-recs")
            metrics = evaluate_als(model, users, labels, k, user_col, item_col, recs).first()
            release(recs)
            gap = normal_residuals(ratings, model.userFactors, model.itemFactors, reg, alpha, user_col, item_col, rating_col)
            rows.append((int(rank), float(reg), float(alpha), *metrics, gap.agg(F.max("residual")).first()[0]))
            held = spark.sparkContext._jsc.getPersistentRDDs()
            for i in set(held) - before:  # the model's factors
                held[i].unpersist()
    finally:
        for f in shared:
            f.unpersist()
        release(labels)
    return spark.createDataFrame(
        rows, "rank int, reg_param double, alpha double, map_at_k double, ndcg_at_k double, precision_at_k double, n_users long, max_residual double")


__all__ = ["prepare_ratings", "build_als", "fit_als", "recommend", "recommendation_lists",
           "evaluate_als", "als_grid", "explode_lists"]
