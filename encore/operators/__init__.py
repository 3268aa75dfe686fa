"""DataFrame -> DataFrame operators (column names are parameters)."""

from encore.operators.clean import drop_nulls, deduplicate, clean, cleaning_counts, stage_counts
from encore.operators.indexing import (
    row_index, dense_index, sparse_index, attach_index, attach_key, id_maps, to_coo,
)
from encore.operators.split import tag_split, per_user_split
from encore.operators.utility import utility_matrix, items_per_user, users_per_item, distinct_users
from encore.operators.support import item_support, min_support, warm_start_filter
from encore.operators.popularity import (
    item_stats, popularity, top_k, popularity_top_k, beta_sweep_top_k, ranked_list,
)
from encore.operators.labels import label_lists, label_arrays, explode_lists
from encore.operators.metrics import ranking_metrics, shared_list_metrics

__all__ = [
    "drop_nulls", "deduplicate", "clean", "cleaning_counts", "stage_counts",
    "row_index", "dense_index", "sparse_index", "attach_index", "attach_key", "id_maps", "to_coo",
    "tag_split", "per_user_split",
    "utility_matrix", "items_per_user", "users_per_item", "distinct_users",
    "item_support", "min_support", "warm_start_filter",
    "item_stats", "popularity", "top_k", "popularity_top_k", "beta_sweep_top_k", "ranked_list",
    "label_lists", "label_arrays", "explode_lists",
    "ranking_metrics", "shared_list_metrics",
]
