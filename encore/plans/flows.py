"""End-to-end flows: raw interactions -> prepared sets -> recommenders -> metrics.

``prepare`` chains the preparation operators: index the catalogue, drop null
keys, attach ids, de-duplicate, split, utility matrix, support filters, labels
(de-duplication runs after the attach join, which only adds a dependent column).
With ``materialize_stages=True`` the tagged split and one utility table for both
sides are written as Parquet tables in the shared checkpoint folder
(``spark.checkpoint.dir``) and read back: the source is read once, and a lost
executor recomputes from those tables.  ``Prepared.release()`` deletes them; what
is not released is deleted when the driver exits.  The split order is a hash, so a
recomputation reproduces it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.als import evaluate_als, fit_als
from encore.operators.clean import clean, deduplicate, drop_nulls, stage_counts
from encore.operators.indexing import attach_index, dense_index
from encore.operators.labels import label_lists
from encore.operators.metrics import shared_list_metrics
from encore.operators.popularity import popularity_top_k
from encore.operators.split import tag_split
from encore.operators.support import min_support
from encore.operators.utility import utility_matrix
from encore.sources.scratch import materialize, release


@dataclass
class Prepared:
    tracks: DataFrame
    train: DataFrame
    val: DataFrame
    utility_train: DataFrame
    utility_val: DataFrame
    #: support threshold -> (train, validation) utility of the items above it
    filtered: dict[int, tuple[DataFrame, DataFrame]]
    labels_val: DataFrame
    tables: tuple[DataFrame, ...] = ()

    @property
    def filtered_train(self) -> DataFrame:
        """The training utility at the first threshold."""
        return next(iter(self.filtered.values()))[0]

    @property
    def filtered_val(self) -> DataFrame:
        return next(iter(self.filtered.values()))[1]

    def release(self) -> None:
        """Delete the intermediate tables; the frames cannot be read afterwards."""
        release(*self.tables)


def split_sides(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of a frame with ``is_train``."""
    return tagged.filter(F.col("is_train")).drop("is_train"), tagged.filter(~F.col("is_train")).drop("is_train")


def split_utility(tagged: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                  count_col: str = "total_count") -> DataFrame:
    """The utility matrices of both sides in one aggregate: ``(user, item, is_train, count)``."""
    return tagged.groupBy(user_col, item_col, "is_train").agg(F.count(F.lit(1)).alias(count_col))


def prepare(interactions: DataFrame, tracks: DataFrame, *, user_col: str = "user_id",
            item_key: str = "item_id", track_key: str = "recording_msid",
            split_keys: Sequence[str] | None = None, how: str = "any", frac: float = 0.8,
            support: int | Sequence[int] = 3, label_k: int = 100, num_partitions: int,
            materialize_stages: bool = False) -> Prepared:
    indexed_tracks = dense_index(tracks, track_key, "song_id", num_partitions=num_partitions)
    kept = drop_nulls(interactions, (user_col, item_key), how=how)
    indexed = attach_index(kept, indexed_tracks, item_key, track_key, "song_id", drop_unmatched=True)
    tagged = tag_split(deduplicate(indexed), user_col, split_keys, frac)
    tables: tuple[DataFrame, ...] = ()
    if materialize_stages:
        tagged = materialize(tagged, "split")
    util = split_utility(tagged, user_col, "song_id")
    if materialize_stages:
        util = materialize(util, "utility")
        tables = (tagged, util)
    train, val = split_sides(tagged)
    u_train, u_val = split_sides(util)
    thresholds = (support,) if isinstance(support, int) else tuple(support)
    return Prepared(
        tracks=indexed_tracks, train=train, val=val, utility_train=u_train, utility_val=u_val,
        filtered={t: (min_support(u_train, t, item_col="song_id"), min_support(u_val, t, item_col="song_id"))
                  for t in thresholds},
        labels_val=label_lists(u_val, label_k, user_col, "song_id"), tables=tables,
    )


@dataclass
class Holdout:
    interactions: DataFrame
    utility: DataFrame
    labels: DataFrame


def prepare_holdout(interactions: DataFrame, indexed_tracks: DataFrame, *, user_col: str = "user_id",
                    item_key: str = "item_id", track_key: str = "recording_msid", how: str = "any",
                    label_k: int = 100, materialize_stages: bool = False) -> Holdout:
    """A separately given test set: cleaned, joined to the *training* catalogue's
    ids (rows without an id are dropped), aggregated, and cut into label lists."""
    cleaned = clean(interactions, (user_col, item_key), how=how)
    indexed = attach_index(cleaned, indexed_tracks, item_key, track_key, "song_id", drop_unmatched=True)
    util = utility_matrix(indexed, user_col, "song_id")
    if materialize_stages:
        util = materialize(util, "utility_test")
    return Holdout(indexed, util, label_lists(util, label_k, user_col, "song_id"))


def holdout_popularity_report(p: Prepared, h: Holdout, k: int = 100, measure: str = "damped",
                              beta: float = 0, user_col: str = "user_id") -> DataFrame:
    """The training popularity list scored on the held-out labels."""
    top = popularity_top_k(p.filtered_train, k, measure, beta, item_col="song_id")
    return shared_list_metrics(top, h.labels, k, user_col=user_col, item_col="song_id")


def stage_report(p: Prepared, user_col: str = "user_id", exact: bool = True) -> DataFrame:
    """Rows, distinct users and distinct items at every prepared stage, for every threshold."""
    stages = [("train", p.train), ("val", p.val), ("utility_train", p.utility_train), ("utility_val", p.utility_val)]
    many = len(p.filtered) > 1
    for t, (train, val) in p.filtered.items():
        end = f"_{t}" if many else ""
        stages += [(f"filtered_train{end}", train), (f"filtered_val{end}", val)]
    return stage_counts(stages, user_col, "song_id", exact=exact)


def popularity_report(p: Prepared, k: int = 100, measure: str = "damped", beta: float = 0,
                      user_col: str = "user_id") -> DataFrame:
    top = popularity_top_k(p.filtered_train, k, measure, beta, item_col="song_id")
    return shared_list_metrics(top, p.labels_val, k, user_col=user_col, item_col="song_id")


def als_report(p: Prepared, rank: int = 40, reg: float = 0.2, alpha: float = 1.0,
               max_iter: int = 10, *, seed: int, num_blocks: int, k: int = 100, user_col: str = "user_id") -> DataFrame:
    model = fit_als(p.filtered_train, rank, reg, alpha, max_iter, seed=seed, num_blocks=num_blocks,
                    user_col=user_col, item_col="song_id")
    users = p.filtered_val.select(user_col)
    return evaluate_als(model, users, p.labels_val, k, user_col, "song_id")
