"""Queries of the features that are stored, verified or merged: see each query's docstring.

They are registered beside ``encore.plans.catalogue``; the DuckDB statements are in
``encore.plans.features_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import als as als_ops
from encore.operators.als_solution import check_last_half_step
from encore.operators.als_topk import recommend_pruned
from encore.operators.growing import store_growth
from encore.operators.hot_keys import left_join_salted
from encore.operators.indexing import id_maps, to_coo
from encore.operators.membership import warm_start_members
from encore.operators.sketches import merge_sketches, relative_error, sketch_parts
from encore.operators.support import min_support
from encore.operators.tiles import from_tiles, tile_sums, to_tiles
from encore.operators.utility import utility_matrix
from encore.plans.catalogue import (
    ALS_BLOCKS, ALS_SEED, ALS_TIMED, EVENT_K, INDEX_PARTITIONS, SPLIT_KEYS, WARM_SUPPORT, events_split_utility, indexed_tracks, sales_split_utility,
)
from encore.plans.sql_forms import register, run_form
from encore.sources.counted import prepare_counted
from encore.sources.paging import RANK, RankIndex, write_rank_index
from encore.sources.scratch import adopt, materialize, scratch_path
from encore.sources.sinks import write_bucketed_by_user
from encore.sources.variants import read_variants, write_variant
from encore.sources.views import event_interactions, sales_interactions, sales_interactions_raw, sales_interactions_with_nulls, track_catalogue

#: Pages read from one stored index: (offset, rows).
PAGES = ((0, 400), (20_000, 600), (5_000, 500))
#: Rows in a folder of that index.
PAGE_FOLDER = 4_096
#: Items in a step of the pruned top-k: the test tables have a hundred items.
TOPK_BLOCK = 8
#: Salts of a hot key, and the share of rows that makes a key hot.
SALTS, HOT_SHARE = 16, 0.002
#: Rows a limit statement returns.
LIMIT_ROWS = 250
BUCKETS = 8


def _als(train):
    p = ALS_TIMED
    return als_ops.fit_als(train, p["rank"], p["reg"], p["alpha"], p["max_iter"], seed=ALS_SEED, num_blocks=ALS_BLOCKS)


def q_als_solution(spark, base):
    """Whether every user's factors of a fitted model solve the normal equation of the last half step."""
    train, _ = events_split_utility(spark, base)
    return check_last_half_step(_als(train), train, ALS_TIMED["reg"], ALS_TIMED["alpha"])


def q_als_pruned_topk(spark, base):
    """Top-10 lists with pruning against those of all scores, per user; and whether any pair was skipped."""
    train, _ = events_split_utility(spark, base)
    model = _als(train)
    ours = materialize(recommend_pruned(model.userFactors, model.itemFactors, EVENT_K, num_partitions=INDEX_PARTITIONS,
                                        block_items=TOPK_BLOCK), "pruned-topk")
    theirs = als_ops.recommend(model, None, EVENT_K).select(F.col("user_id").alias("u"), F.col("rank").alias("r"), F.col("rating").alias("full"))
    both = ours.join(theirs, (F.col("user_id") == F.col("u")) & (F.col("rank") == F.col("r")), "full")
    same = F.coalesce(F.abs(F.col("rating") - F.col("full")) < 1e-5, F.lit(False))
    n_items = model.itemFactors.select(F.count(F.lit(1))).scalar()
    scored = ours.select(F.avg("n_scored")).scalar()
    return both.groupBy(F.coalesce("user_id", "u").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_recs"), F.min(same).alias("same_ratings"), F.countDistinct("item_id").alias("n_items")).withColumn(
        "pairs_skipped", scored < n_items)


def q_paged_export(spark, base):
    """Three pages of the sales interactions in key order from one stored index."""
    path = adopt(spark, scratch_path(spark, "rank-index"))
    write_rank_index(sales_interactions(spark, base), list(SPLIT_KEYS), path, num_partitions=INDEX_PARTITIONS, rows_per_file=PAGE_FOLDER)
    index = RankIndex(spark, path)
    out = None
    for n, (offset, size) in enumerate(PAGES):
        page = index.page(offset, size).withColumnRenamed(RANK, "place").withColumn("page", F.lit(n))
        out = page if out is None else out.unionByName(page)
    return out


def q_observed_counts(spark, base):
    """Rows of every stage from raw interactions to utility matrices, counted while the tables were written."""
    return prepare_counted(sales_interactions_raw(spark, base), list(SPLIT_KEYS))[1]


def q_sketched_counts(spark, base):
    """Users and items of the split's sides and of both: exact, and whether sketches merged from 16 parts agree."""
    util = materialize(_sides(*sales_split_utility(spark, base)), "sketched-rows")
    parts = sketch_parts(util.withColumn("part", F.pmod("user_id", F.lit(16))), ["side", "part"], ["user_id", "item_id"])
    stored = materialize(parts, "sketches")
    found = merge_sketches(stored, ["side"], ["user_id", "item_id"]).unionByName(
        merge_sketches(stored, [], ["user_id", "item_id"]).withColumn("side", F.lit("both")))
    count = lambda df: df.agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"))
    exact = count(util.groupBy("side")).unionByName(count(util).withColumn("side", F.lit("both")))
    near = lambda a, n: F.abs(F.col(a) - F.col(n)) <= F.lit(relative_error()) * F.col(n)
    return exact.join(found, "side").select("side", "n_rows", "n_users", "n_items", near("approx_user_id", "n_users").alias("users_agree"),
                                            near("approx_item_id", "n_items").alias("items_agree"))


def _sides(train, val):
    return train.withColumn("side", F.lit("train")).unionByName(val.withColumn("side", F.lit("val")))


def q_variant_overwrite(spark, base):
    """Two variants of the utility matrix in one table, one of them then replaced; rows with the variant their file is of."""
    path = adopt(spark, scratch_path(spark, "variants"))
    sales, events = utility_matrix(sales_interactions(spark, base)), utility_matrix(event_interactions(spark, base))
    kinds = [F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"), "total_count"]
    write_variant(sales.select(*kinds), path, "sales")
    write_variant(events.select(*kinds), path, "events")
    write_variant(min_support(sales, 30).select(*kinds), path, "sales")
    rows = read_variants(spark, path, sales.select(*kinds).schema, origin=True)
    return rows.select("user_id", "item_id", "total_count", "variant", F.regexp_extract("origin_file", "variant=([a-z]+)/", 1).alias("origin"))


def q_grown_track_index(spark, base):
    """A dictionary of the tracks with even sizes that then takes in all tracks: old ids stay, new ones follow."""
    path = adopt(spark, scratch_path(spark, "grown"))
    tracks = track_catalogue(spark, base)
    store_growth(path, tracks.where("p_size % 2 = 0"), num_partitions=INDEX_PARTITIONS)
    return store_growth(path, tracks, num_partitions=INDEX_PARTITIONS)


def q_warm_start_bloom(spark, base):
    """The warm-start filter with Bloom filters in front of its shuffles."""
    train, val = sales_split_utility(spark, base)
    return warm_start_members(val, materialize(min_support(train, WARM_SUPPORT, scope="self"), "warm-train"))


def _coo(spark, base):
    train, val = events_split_utility(spark, base)
    users, items = id_maps(train, num_partitions=INDEX_PARTITIONS)
    return to_coo(val, users, items)


def q_tiles_round_trip(spark, base):
    """The validation entries as compressed tiles and back."""
    return from_tiles(to_tiles(_coo(spark, base))).withColumn("weight", F.col("weight").cast("long"))


def q_tile_sums(spark, base):
    """Sums of the weights of every row and column, from the tiles."""
    tiles = materialize(to_tiles(_coo(spark, base)), "tiles")
    part = lambda axis: tile_sums(tiles, axis).select(F.lit(axis).alias("axis"), "idx", F.col("total").cast("long").alias("total"))
    return part("row").unionByName(part("col"))


def q_attach_index_salted(spark, base):
    """Song ids attached by a left join in which null keys are passed by and hot keys are salted."""
    facts = sales_interactions_raw(spark, base).withColumn("__key", F.col("item_id").cast("string"))
    tracks = indexed_tracks(spark, base).select("recording_msid", "song_id").distinct()
    out = left_join_salted(facts, tracks, "__key", "recording_msid", ["song_id"], salts=SALTS, share=HOT_SHARE)
    return out.select("user_id", "item_id", "ts", "l_orderkey", "l_linenumber", "song_id")


def q_sink_bucketed(spark, base):
    """The sales utility matrix as a table bucketed by user, read back and joined with itself on the bucket key."""
    path = adopt(spark, scratch_path(spark, "bucketed"))
    name = "encore_bucketed_" + path.rsplit("-", 1)[-1]
    table = write_bucketed_by_user(utility_matrix(sales_interactions(spark, base)), name, path, BUCKETS, sort_cols=["user_id"])
    per_user = table.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_items"))
    return table.join(per_user, "user_id")


def _form(form, source, **args):
    def q(spark, base):
        view = register(source(spark, base), f"encore_{form}")
        return run_form(spark, form, view=view, **args)
    q.__name__ = f"q_sql_{form}"
    q.__doc__ = f"The statement form {form!r} as text over a registered view."
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "als_solution": q_als_solution,
    "als_pruned_topk": q_als_pruned_topk,
    "paged_export": q_paged_export,
    "observed_counts": q_observed_counts,
    "sketched_counts": q_sketched_counts,
    "variant_overwrite": q_variant_overwrite,
    "grown_track_index": q_grown_track_index,
    "warm_start_bloom": q_warm_start_bloom,
    "tiles_round_trip": q_tiles_round_trip,
    "tile_sums": q_tile_sums,
    "attach_index_salted": q_attach_index_salted,
    "sink_bucketed": q_sink_bucketed,
    "sql_count": _form("count", sales_interactions_raw),
    "sql_count_distinct": _form("count_distinct", sales_interactions_raw, a="user_id", b="item_id"),
    "sql_some_key": _form("some_key", sales_interactions_with_nulls, a="user_id", b="item_id"),
    "sql_distinct": _form("distinct", sales_interactions_with_nulls),
    "sql_first_rows": _form("first_rows", sales_interactions, n=LIMIT_ROWS),
}
