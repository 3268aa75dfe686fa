"""Row counts recorded for the sf0.01 tables (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from encore.operators import (
    attach_index, clean, dense_index, drop_nulls, min_support, per_user_split, utility_matrix,
)
from encore.plans.catalogue import SPLIT_KEYS
from encore.sources.views import (
    event_interactions, sales_interactions, sales_interactions_with_nulls, track_catalogue,
)

from conftest import MEDIUM


def test_null_injection_counts(spark):
    df = sales_interactions_with_nulls(spark, MEDIUM)
    got = df.agg(
        F.count(F.lit(1)),
        F.count(F.when(F.col("user_id").isNull(), 1)),
        F.count(F.when(F.col("item_id").isNull(), 1)),
        F.count(F.when(F.col("user_id").isNull() & F.col("item_id").isNull(), 1)),
    ).collect()[0]
    assert tuple(got) == (60000, 6088, 4176, 2434)
    assert drop_nulls(df, ["user_id", "item_id"], "all").count() == 57566
    assert clean(df, how="all").count() == 57427
    assert drop_nulls(df, ["user_id", "item_id"], "any").count() == 52170
    assert clean(df, how="any").count() == 52125


def test_split_and_support_counts(spark):
    inter = sales_interactions(spark, MEDIUM)
    train, val = per_user_split(inter, "user_id", SPLIT_KEYS)
    assert (train.count(), val.count()) == (48605, 11395)
    u_train, u_val = utility_matrix(train), utility_matrix(val)
    assert u_train.count() == 48217 and u_val.count() == 11373
    assert [min_support(u_train, t).count() for t in (3, 10, 15, 30)] == [48217, 48217, 47345, 6236]
    assert [min_support(u_val, t).count() for t in (3, 10, 15, 30)] == [10530, 642, 16, 0]
    assert min_support(u_val, 30, scope="train", reference=u_train).count() == 1078


def test_index_and_event_counts(spark):
    tracks = track_catalogue(spark, MEDIUM).filter("p_size <= 40")
    assert tracks.count() == 1605
    idx = dense_index(tracks, "recording_msid", "song_id", num_partitions=4)
    matched = attach_index(sales_interactions(spark, MEDIUM), idx, "item_id", "recording_msid",
                           "song_id", drop_unmatched=True)
    assert matched.count() == 48169
    util = utility_matrix(event_interactions(spark, MEDIUM))
    stats = util.agg(F.count(F.lit(1)), F.countDistinct("user_id"), F.countDistinct("item_id"),
                     F.max("total_count")).collect()[0]
    assert tuple(stats) == (7310, 150, 100, 6)
