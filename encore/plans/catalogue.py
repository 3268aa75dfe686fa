"""The query catalogue: one ``(spark, base_dir) -> DataFrame`` per operator.

Each query reads the input tables at ``base_dir`` (see ``encore.sources.views``)
and runs over whole tables.  Output columns are named to match the DuckDB
statements in ``encore.plans.oracle``: doubles are rounded to 9 places and
ranks/ids are INT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.functions.columns import rounded
from encore.operators import als as als_ops
from encore.operators.als_solution import TOLERANCE, normal_residuals
from encore.operators.clean import clean, cleaning_counts
from encore.operators.indexing import attach_index, dense_index, id_maps, sparse_index, to_coo
from encore.operators.labels import explode_lists, label_arrays, label_lists
from encore.operators.metrics import shared_list_metrics
from encore.operators.popularity import beta_sweep_top_k, popularity_top_k, ranked_list
from encore.operators.split import per_user_split, tag_split
from encore.operators.support import min_support, warm_start_filter
from encore.operators.utility import items_per_user, users_per_item, utility_matrix
from encore.plans.flows import split_sides, split_utility
from encore.sources.scratch import adopt, materialize, scratch_path
from encore.sources.sinks import bounded_export, page, write_by_user, write_parquet
from encore.sources.views import (
    event_interactions, sales_interactions, sales_interactions_raw, sales_interactions_with_nulls, track_catalogue,
)

# --- fixed values: parameters of the original experiments ---------------------
TRAIN_FRACTION = 0.8
SUPPORT_THRESHOLDS = (3, 10, 15, 30)
TOP_K = 100
DAMPED_BETA = 500000
BETA_SWEEP = (50000, 60000, 70000, 80000, 90000, 100000, 120000, 150000)
ALS_TIMED = dict(rank=40, reg=0.2, alpha=1.0, max_iter=10)
ALS_VALIDATE = dict(rank=40, reg=0.15, alpha=1.0, max_iter=20)
ALS_GRID = dict(ranks=(40,), regs=(0.15, 0.2), alphas=(0.5, 0.75), max_iter=10)
WARM_SUPPORT = 30
# --- parameters chosen here for the test tables ---------------------------------
WEIGHTED_BETA = 1        # the beta form of the weighted score (the original ran beta 0)
WEIGHTED_SWEEP = (0, 0.5, 1, 2.5)
PAGE_OFFSET = 1000       # a page inside the sf0.01 catalogue
PAGE_SIZE = 500
EXPORT_ROWS = 25000      # the original's cap of 55,000,000 rows exceeds the test tables
EVENT_K = 10             # event users have at most 67 of 100 items, so k=10 exercises the cut
ALS_SEED = 42            # the original passed no seed
ALS_BLOCKS = 10          # fixed, so that a fit does not depend on the cluster
INDEX_PARTITIONS = 16    # ranges that are numbered side by side
# ------------------------------------------------------------------------------

SPLIT_KEYS = ("user_id", "item_id", "l_orderkey", "l_linenumber")
EVENT_SPLIT_KEYS = ("user_id", "item_id", "event_id")
R9 = 9


def _r(col: str) -> F.Column:
    return rounded(col, R9).alias(col)


# --- shared building blocks ---------------------------------------------------

def sales_split(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return per_user_split(sales_interactions(spark, base), "user_id", SPLIT_KEYS, TRAIN_FRACTION)


def _split_utility(interactions: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Both sides' utility from one written table, so the source is read once."""
    tagged = tag_split(interactions, "user_id", keys, TRAIN_FRACTION)
    return split_sides(materialize(split_utility(tagged), "split-utility"))


def sales_split_utility(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return _split_utility(sales_interactions(spark, base), SPLIT_KEYS)


def events_split_utility(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return _split_utility(event_interactions(spark, base), EVENT_SPLIT_KEYS)


def indexed_tracks(spark: SparkSession, base: str) -> DataFrame:
    return dense_index(track_catalogue(spark, base), "recording_msid", "song_id", num_partitions=INDEX_PARTITIONS)


# --- cleaning and counts ------------------------------------------------------

def q_clean_all(spark, base):
    """Null-injected sales rows without rows whose keys are both null, de-duplicated."""
    return clean(sales_interactions_with_nulls(spark, base), ("user_id", "item_id"), how="all")


def q_clean_any(spark, base):
    """Null-injected sales rows without rows having any null key, de-duplicated."""
    return clean(sales_interactions_with_nulls(spark, base), ("user_id", "item_id"), how="any")


def q_stage_counts(spark, base):
    """Rows, users and items after each cleaning stage, from one pass over the source."""
    return cleaning_counts(sales_interactions_with_nulls(spark, base))


# --- indexing -------------------------------------------------------------------

def q_dense_track_index(spark, base):
    """Track catalogue with dense song ids 1..N in key order."""
    return indexed_tracks(spark, base)


def q_page_by_row_number(spark, base):
    """One page of the catalogue in key order (rows 1001-1500)."""
    return page(track_catalogue(spark, base), ["recording_msid"], PAGE_OFFSET, PAGE_SIZE,
                num_partitions=INDEX_PARTITIONS)


def q_sparse_track_index(spark, base):
    """Row count and distinct-id count of the gapped LONG ids."""
    ids = sparse_index(track_catalogue(spark, base), "row_id")
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


def _attach(spark, base, drop_unmatched):
    facts = sales_interactions_raw(spark, base)
    out = attach_index(facts, indexed_tracks(spark, base), "item_id", "recording_msid", "song_id",
                       drop_unmatched=drop_unmatched)
    return out.select("user_id", "item_id", "ts", "l_orderkey", "l_linenumber", "song_id")


def q_attach_index_left(spark, base):
    """Raw sales rows with song ids; rows without a catalogue row (or item) keep a null id."""
    return _attach(spark, base, False)


def q_attach_index_matched(spark, base):
    """Raw sales rows with song ids; unmatched rows dropped."""
    return _attach(spark, base, True)


# --- split ------------------------------------------------------------------------

def q_split_train(spark, base):
    """Per-user training part of the sales rows (first 80% in md5 order)."""
    return sales_split(spark, base)[0]


def q_split_val(spark, base):
    """Per-user validation part of the sales rows."""
    return sales_split(spark, base)[1]


# --- utility matrix and counts ---------------------------------------------------

def q_utility_matrix(spark, base):
    """Sales utility matrix (user, item, total_count)."""
    return utility_matrix(sales_interactions(spark, base))


def q_utility_matrix_dense(spark, base):
    """Event utility matrix (user, item, total_count)."""
    return utility_matrix(event_interactions(spark, base))


def q_items_per_user(spark, base):
    """Items per user of the event utility matrix."""
    return items_per_user(utility_matrix(event_interactions(spark, base)))


def q_users_per_item(spark, base):
    """Users per item of the event utility matrix."""
    return users_per_item(utility_matrix(event_interactions(spark, base)))


def _min_support_self(threshold):
    def q(spark, base):
        # the validation side is sparse enough for the lower thresholds to remove items
        util = sales_split_utility(spark, base)[1] if threshold < 30 else utility_matrix(sales_interactions(spark, base))
        return min_support(util, threshold, scope="self")
    q.__name__ = f"q_min_support_self_{threshold}"
    return q


def q_min_support_train_10(spark, base):
    """Training pairs of the items that more than 10 validation users have."""
    train, val = sales_split_utility(spark, base)
    return min_support(train, 10, scope="train", reference=val)


def q_min_support_train_30(spark, base):
    """Validation pairs of the items that more than 30 training users have."""
    train, val = sales_split_utility(spark, base)
    return min_support(val, 30, scope="train", reference=train)


# --- popularity ---------------------------------------------------------------------

def q_popularity_damped(spark, base):
    """Top-100 items by sum / (listeners + 500000)."""
    top = popularity_top_k(utility_matrix(sales_interactions(spark, base)), TOP_K, "damped", DAMPED_BETA)
    return top.select("item_id", _r("popularity"), "rank")


def _whole(top: DataFrame) -> DataFrame:
    # the scores of the test tables fit 64 bits
    return top.withColumn("popularity", F.col("popularity").cast("long"))


def q_popularity_weighted(spark, base):
    """Top-100 items by sum * listeners."""
    return _whole(popularity_top_k(utility_matrix(sales_interactions(spark, base)), TOP_K, "weighted", 0))


def q_popularity_weighted_beta(spark, base):
    """Top-100 items by sum * (listeners + 1)."""
    return _whole(popularity_top_k(utility_matrix(sales_interactions(spark, base)), TOP_K, "weighted", WEIGHTED_BETA))


def _rounded_metrics(m: DataFrame, *keys: str) -> DataFrame:
    return m.select(*keys, _r("map_at_k"), _r("ndcg_at_k"), _r("precision_at_k"), "n_users")


def _sweep_topk(spark, base, measure, betas):
    train, _ = sales_split_utility(spark, base)
    return beta_sweep_top_k(train, betas, TOP_K, measure).select("beta", "item_id", _r("popularity"), "rank")


def _sweep_metrics(spark, base, measure, betas):
    train, val = sales_split_utility(spark, base)
    top = beta_sweep_top_k(train, betas, TOP_K, measure)
    parts = []
    for name, util in (("train", train), ("val", val)):
        m = shared_list_metrics(top, label_lists(util, TOP_K), TOP_K, group_cols=["beta"])
        parts.append(m.select(F.lit(name).alias("label_set"), "*"))
    return _rounded_metrics(parts[0].unionByName(parts[1]), "label_set", "beta")


def q_beta_sweep_topk(spark, base):
    """Top-100 damped list for every beta of the sweep, in one pass."""
    return _sweep_topk(spark, base, "damped", BETA_SWEEP).withColumn("beta", F.col("beta").cast("long"))


def q_beta_sweep_topk_weighted(spark, base):
    """Top-100 weighted list for every beta of a sweep with fractional values."""
    return _sweep_topk(spark, base, "weighted", WEIGHTED_SWEEP)


def q_beta_sweep_metrics(spark, base):
    """Every damped list scored on the training labels and on the validation labels."""
    return _sweep_metrics(spark, base, "damped", BETA_SWEEP).withColumn("beta", F.col("beta").cast("long"))


def q_beta_sweep_metrics_weighted(spark, base):
    """Every weighted list scored on the training labels and on the validation labels."""
    return _sweep_metrics(spark, base, "weighted", WEIGHTED_SWEEP)


def q_popularity_eval(spark, base):
    """Damped top-100 of the training split scored on validation labels."""
    train, val = sales_split_utility(spark, base)
    top = popularity_top_k(train, TOP_K, "damped", DAMPED_BETA)
    return _rounded_metrics(shared_list_metrics(top, label_lists(val, TOP_K), TOP_K))


# --- labels -----------------------------------------------------------------------------

def q_label_lists(spark, base):
    """Each event user's top-10 items by count (larger item first on ties)."""
    return label_lists(utility_matrix(event_interactions(spark, base)), EVENT_K)


def q_label_arrays(spark, base):
    """The same lists as arrays, one row per user, exploded again with their places."""
    labels = label_lists(utility_matrix(event_interactions(spark, base)), EVENT_K)
    return explode_lists(label_arrays(labels, EVENT_K), "actual_songs", rank_col="label_rank")


def q_ranked_list(spark, base):
    """The damped top-100 as one array row, exploded again with its places."""
    top = popularity_top_k(utility_matrix(sales_interactions(spark, base)), TOP_K, "damped", DAMPED_BETA)
    return ranked_list(top).select(F.posexplode("popular_songs").alias("at", "item_id")).select(
        "item_id", (F.col("at") + 1).alias("rank"))


# --- warm start, id maps, COO --------------------------------------------------------------

def _warm_val(spark, base):
    train, val = sales_split_utility(spark, base)
    train_kept = min_support(train, WARM_SUPPORT, scope="self")
    return train_kept, warm_start_filter(val, train_kept)


def q_warm_start_filter(spark, base):
    """Validation pairs whose user and item occur in the support-filtered training set."""
    return _warm_val(spark, base)[1]


def q_precision_at_k_warm(spark, base):
    """Weighted top-100 of the filtered training set scored on the warm validation pairs."""
    train_kept, warm = _warm_val(spark, base)
    top = popularity_top_k(train_kept, TOP_K, "weighted", 0)
    # every held-out pair is a label (no cut), so no per-user ranking is needed
    return _rounded_metrics(shared_list_metrics(top, warm.select("user_id", "item_id"), TOP_K))


def q_id_maps(spark, base):
    """Contiguous 0-based ids of event users and items."""
    util = utility_matrix(event_interactions(spark, base))
    users, items = id_maps(util, num_partitions=INDEX_PARTITIONS)
    return (users.select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), F.col("user_idx").alias("idx"))
            .unionByName(items.select(F.lit("item").alias("kind"), F.col("item_id").cast("long").alias("key"),
                                      F.col("item_idx").alias("idx"))))


def q_coo_matrix(spark, base):
    """Validation events as COO entries over the training id maps."""
    train, val = events_split_utility(spark, base)
    users, items = id_maps(train, num_partitions=INDEX_PARTITIONS)
    return to_coo(val, users, items)


# --- sinks, read back ---------------------------------------------------------------------

def q_bounded_export(spark, base):
    """The first 25,000 sales rows in key order, written and read back."""
    path = adopt(spark, scratch_path(spark, "bounded-export"))
    return bounded_export(sales_interactions(spark, base), list(SPLIT_KEYS), EXPORT_ROWS, path,
                          num_partitions=INDEX_PARTITIONS)


def q_sink_parquet(spark, base):
    """The event utility matrix, written and read back."""
    path = adopt(spark, scratch_path(spark, "sink-parquet"))
    write_parquet(utility_matrix(event_interactions(spark, base)), path)
    return spark.read.parquet(path)


def q_sink_by_user(spark, base):
    """The sales utility matrix written clustered by user, and read back."""
    path = adopt(spark, scratch_path(spark, "sink-by-user"))
    write_by_user(utility_matrix(sales_interactions(spark, base)), path)
    return spark.read.parquet(path)


# --- end to end -----------------------------------------------------------------------

def _prepared(spark, base, support=SUPPORT_THRESHOLDS[0], interactions=None):
    from encore.plans.flows import prepare
    raw = sales_interactions_raw(spark, base) if interactions is None else interactions
    return prepare(raw, track_catalogue(spark, base), split_keys=SPLIT_KEYS, how="any", frac=TRAIN_FRACTION,
                   support=support, label_k=TOP_K, num_partitions=INDEX_PARTITIONS, materialize_stages=True)


def q_end_to_end_popularity(spark, base):
    """Raw rows with nulls and orphans -> prepared sets -> damped popularity scored on validation."""
    from encore.plans.flows import popularity_report
    return _rounded_metrics(popularity_report(_prepared(spark, base), TOP_K, "damped", DAMPED_BETA))


def q_end_to_end_stage_counts(spark, base):
    """Rows, users and items at every stage of one preparation with all four thresholds."""
    from encore.plans.flows import stage_report
    return stage_report(_prepared(spark, base, SUPPORT_THRESHOLDS))


def _holdout(spark, base):
    """A training set and a held-out test set that share the table between them."""
    from encore.plans.flows import prepare_holdout
    raw = sales_interactions_raw(spark, base)
    test = F.pmod("l_orderkey", F.lit(5)) == 0
    p = _prepared(spark, base, interactions=raw.filter(~test))
    return p, prepare_holdout(raw.filter(test), p.tracks, label_k=TOP_K, materialize_stages=True)


def q_holdout_popularity(spark, base):
    """Training popularity scored on a separately given test set."""
    from encore.plans.flows import holdout_popularity_report
    p, h = _holdout(spark, base)
    return _rounded_metrics(holdout_popularity_report(p, h, TOP_K, "damped", DAMPED_BETA))


def q_holdout_utility(spark, base):
    """The test set's utility matrix over the training catalogue's ids."""
    return _holdout(spark, base)[1].utility


# --- ALS: what must hold of any model, checked on the whole output -------------------------

def _als_model(train, params):
    return als_ops.fit_als(train, params["rank"], params["reg"], params["alpha"], params["max_iter"],
                           seed=ALS_SEED, num_blocks=ALS_BLOCKS)


def _recommendation_checks(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Per user: how many recommendations, distinct items and places, and what must not occur."""
    w = Window.partitionBy("user_id").orderBy("rank")
    items = train.select("item_id").distinct().withColumn("known", F.lit(1))
    marked = (recs.withColumn("rise", (F.lag("rating").over(w) < F.col("rating")).cast("long"))
                  .withColumn("gap", (F.col("rank") != F.row_number().over(w)).cast("long"))
                  .join(items, "item_id", "left"))
    return marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.countDistinct("item_id").alias("n_items"),
        F.max("rank").cast("long").alias("last_rank"), F.sum("gap").alias("n_gaps"),
        F.coalesce(F.sum("rise"), F.lit(0)).alias("n_rises"),
        F.count(F.when(F.col("known").isNull(), 1)).alias("n_unknown_items"))


def q_als_recommend(spark, base):
    """Checks of the top-10 ALS recommendations for the validation users."""
    train, val = events_split_utility(spark, base)
    return _recommendation_checks(als_ops.recommend(_als_model(train, ALS_TIMED), val.select("user_id"), EVENT_K), train)


def q_als_recommend_all(spark, base):
    """Checks of the top-10 ALS recommendations for every training user."""
    train, _ = events_split_utility(spark, base)
    return _recommendation_checks(als_ops.recommend(_als_model(train, ALS_TIMED), None, EVENT_K), train)


def _metric_checks(model, train: DataFrame, val: DataFrame, params) -> DataFrame:
    """The metrics' range, their difference from Spark ML's evaluator on array-valued lists, and whether
    every user's factors solve their normal equation."""
    # written once: the metrics read labels and recommendations twice each, and every call of the evaluator reads all pairs
    labels = materialize(label_lists(val, EVENT_K), "als-labels")
    recs = materialize(als_ops.recommend(model, val.select("user_id"), EVENT_K), "als-recs")
    m = als_ops.evaluate_als(model, val.select("user_id"), labels, EVENT_K, recs=recs)
    pairs = materialize(als_ops.recommendation_lists(recs, out_col="prediction").join(label_arrays(labels, EVENT_K, out_col="label"), "user_id").select(
        F.col("prediction").cast("array<double>").alias("prediction"), F.col("label").cast("array<double>").alias("label")), "als-pairs")
    second = {name: RankingEvaluator(metricName=name, k=EVENT_K).evaluate(pairs)
              for name in ("meanAveragePrecisionAtK", "ndcgAtK", "precisionAtK")}
    gap = normal_residuals(train, model.userFactors, model.itemFactors, params["reg"], params["alpha"])
    checks = [F.col("n_users"), gap.select(F.max("residual") <= TOLERANCE).scalar().alias("solved")]
    for ours, theirs in zip(("map_at_k", "ndcg_at_k", "precision_at_k"), second.values(), strict=True):
        checks += [F.col(ours).between(0, 1).alias(f"{ours}_in_range"),
                   (F.abs(F.col(ours) - F.lit(float(theirs))) < 1e-9).alias(f"{ours}_agrees")]
    return m.select(*checks)


def q_als_eval(spark, base):
    """ALS (validation parameters) scored on validation labels, twice; and whether its factors are a solution."""
    train, val = events_split_utility(spark, base)
    return _metric_checks(_als_model(train, ALS_VALIDATE), train, val, ALS_VALIDATE)


def q_als_test(spark, base):
    """ALS of the support-filtered training set scored on validation labels, twice."""
    train, val = events_split_utility(spark, base)
    kept = min_support(train, SUPPORT_THRESHOLDS[0], scope="self")
    return _metric_checks(_als_model(kept, ALS_TIMED), kept, val, ALS_TIMED)


def q_als_grid(spark, base):
    """One row per parameter set: the users scored, the metrics' range, and whether the factors solve their equations."""
    train, val = events_split_utility(spark, base)
    g = ALS_GRID
    grid = als_ops.als_grid(train, val.select("user_id"), label_lists(val, EVENT_K), g["ranks"], g["regs"], g["alphas"],
                            EVENT_K, g["max_iter"], seed=ALS_SEED, num_blocks=ALS_BLOCKS)
    in_range = F.col("map_at_k").between(0, 1) & F.col("ndcg_at_k").between(0, 1) & F.col("precision_at_k").between(0, 1)
    return grid.select("rank", "reg_param", "alpha", "n_users", in_range.alias("in_range"),
                       (F.col("max_residual") <= TOLERANCE).alias("solved"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_all": q_clean_all,
    "clean_any": q_clean_any,
    "stage_counts": q_stage_counts,
    "dense_track_index": q_dense_track_index,
    "page_by_row_number": q_page_by_row_number,
    "sparse_track_index": q_sparse_track_index,
    "attach_index_left": q_attach_index_left,
    "attach_index_matched": q_attach_index_matched,
    "split_train": q_split_train,
    "split_val": q_split_val,
    "utility_matrix": q_utility_matrix,
    "utility_matrix_dense": q_utility_matrix_dense,
    "items_per_user": q_items_per_user,
    "users_per_item": q_users_per_item,
    **{f"min_support_self_{t}": _min_support_self(t) for t in SUPPORT_THRESHOLDS},
    "min_support_train_10": q_min_support_train_10,
    "min_support_train_30": q_min_support_train_30,
    "popularity_damped": q_popularity_damped,
    "popularity_weighted": q_popularity_weighted,
    "popularity_weighted_beta": q_popularity_weighted_beta,
    "beta_sweep_topk": q_beta_sweep_topk,
    "beta_sweep_topk_weighted": q_beta_sweep_topk_weighted,
    "beta_sweep_metrics": q_beta_sweep_metrics,
    "beta_sweep_metrics_weighted": q_beta_sweep_metrics_weighted,
    "popularity_eval": q_popularity_eval,
    "label_lists": q_label_lists,
    "label_arrays": q_label_arrays,
    "ranked_list": q_ranked_list,
    "warm_start_filter": q_warm_start_filter,
    "precision_at_k_warm": q_precision_at_k_warm,
    "id_maps": q_id_maps,
    "coo_matrix": q_coo_matrix,
    "bounded_export": q_bounded_export,
    "sink_parquet": q_sink_parquet,
    "sink_by_user": q_sink_by_user,
    "end_to_end_popularity": q_end_to_end_popularity,
    "end_to_end_stage_counts": q_end_to_end_stage_counts,
    "holdout_popularity": q_holdout_popularity,
    "holdout_utility": q_holdout_utility,
    "als_recommend": q_als_recommend,
    "als_recommend_all": q_als_recommend_all,
    "als_eval": q_als_eval,
    "als_test": q_als_test,
    "als_grid": q_als_grid,
}
