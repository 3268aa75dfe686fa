"""Operator properties: null rules, split rule, dense ids, support filter, paging."""

import pytest
from pyspark.sql import functions as F

from encore.operators import (
    attach_index, clean, dense_index, drop_nulls, min_support, per_user_split, row_index,
    tag_split, utility_matrix, warm_start_filter,
)
from encore.sources.sinks import bounded_export, page, write_by_user
from encore.sources.views import sales_interactions, track_catalogue

from conftest import SMALL


def test_null_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, None)], "u long, i string")
    assert drop_nulls(df, ["u", "i"], "all").count() == 3
    assert drop_nulls(df, ["u", "i"], "any").count() == 1


def test_clean_dedups(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, None), (None, None)], "user_id long, item_id long")
    assert clean(df, how="all").count() == 2
    assert clean(df, how="any").count() == 1


def test_split_sizes_per_user(spark):
    rows = [(u, i) for u in range(1, 11) for i in range(u)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    train, val = per_user_split(df, "user_id", ["user_id", "item_id"])
    got = {r.user_id: r["count"] for r in train.groupBy("user_id").count().collect()}
    assert [got[n] for n in range(1, 11)] == [1, 2, 3, 4, 4, 5, 6, 7, 8, 8]
    assert train.count() + val.count() == df.count()


def test_split_is_partition_independent_and_complete(spark):
    df = sales_interactions(spark, SMALL)
    a = tag_split(df, "user_id", ["user_id", "item_id", "l_orderkey", "l_linenumber"])
    b = tag_split(df.repartition(7), "user_id", ["user_id", "item_id", "l_orderkey", "l_linenumber"], slices=16)
    key = ["user_id", "item_id", "l_orderkey", "l_linenumber", "is_train"]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0
    train, val = per_user_split(df, "user_id", ["user_id", "item_id", "l_orderkey", "l_linenumber"])
    assert train.unionByName(val).exceptAll(df).count() == 0
    assert df.exceptAll(train.unionByName(val)).count() == 0


def test_split_plans_agree(spark):
    """One slice (a single window per user), some slices and many slices give one split."""
    df = sales_interactions(spark, SMALL).unionByName(
        spark.createDataFrame([(None, i, None, i, 1) for i in range(30)],
                              "user_id long, item_id long, ts timestamp_ntz, l_orderkey long, l_linenumber int"))
    keys = ["user_id", "item_id", "l_orderkey", "l_linenumber"]
    cols = keys + ["is_train"]
    plain = tag_split(df, "user_id", keys, slices=1).select(*cols)
    heavy = tag_split(df, "user_id", keys, slices=7).select(*cols)
    sliced = tag_split(df, "user_id", keys).select(*cols)
    for other in (heavy, sliced):
        assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0
    assert plain.filter("user_id is null and is_train").count() == 24


def test_split_fraction_with_a_large_denominator(spark):
    df = spark.range(5000).select(F.lit(1).alias("user_id"), F.col("id").alias("item_id"))
    train, val = per_user_split(df, "user_id", ["user_id", "item_id"], frac=0.799999)
    assert (train.count(), val.count()) == (4000, 1000)  # 5001 * 0.799999 = 4000.79...


def test_split_does_not_depend_on_the_time_zone(spark):
    rows = spark.range(400).selectExpr("id % 20 AS user_id", "timestamp_seconds(id * 7919) AS ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for z in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got.append({(r.user_id, r.t) for r in tag_split(rows, "user_id").filter("is_train")
                        .selectExpr("user_id", "unix_seconds(ts) AS t").collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0] == got[1]


def test_row_index_is_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = row_index(df, "k", "idx", num_partitions=6)
    stats = out.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).collect()[0]
    assert tuple(stats) == (1, 5000, 5000)
    assert out.filter(F.col("idx") != F.col("k") + 1).count() == 0


def test_dense_index_distinct_keys_share_ids(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "key string, v int")
    out = {r.v: r.song_id for r in dense_index(df, "key", "song_id", num_partitions=4).collect()}
    assert out == {2: 1, 1: 2, 3: 2, 4: None}
    rows = dense_index(df.filter("key is not null"), "key", "rid", distinct=False, num_partitions=4).collect()
    assert sorted(r.rid for r in rows) == [1, 2, 3]


def test_attach_index(spark):
    tracks = dense_index(track_catalogue(spark, SMALL).filter("p_size <= 40"), "recording_msid", "song_id", num_partitions=4)
    facts = sales_interactions(spark, SMALL)
    left = attach_index(facts, tracks, "item_id", "recording_msid", "song_id")
    inner = attach_index(facts, tracks, "item_id", "recording_msid", "song_id", drop_unmatched=True)
    assert left.count() == facts.count()
    assert inner.count() == left.filter(F.col("song_id").isNotNull()).count()


def test_min_support_scopes_and_idempotence(spark):
    util = utility_matrix(sales_interactions(spark, SMALL))
    kept = min_support(util, 30)
    assert kept.groupBy("item_id").count().filter("count <= 30").count() == 0
    assert min_support(kept, 30).count() == kept.count()
    train, val = per_user_split(util, "user_id", ["user_id", "item_id"])
    scoped = min_support(val, 30, scope="train", reference=train)
    ok_items = train.groupBy("item_id").count().filter("count > 30").select("item_id")
    assert scoped.join(ok_items, "item_id", "left_anti").count() == 0


def test_warm_start(spark):
    train = spark.createDataFrame([(1, 10), (2, 20)], "user_id long, item_id long")
    test = spark.createDataFrame([(1, 20), (1, 30), (3, 10)], "user_id long, item_id long")
    assert [tuple(r) for r in warm_start_filter(test, train).collect()] == [(1, 20)]


def test_page_and_bounded_export(spark, scratch):
    df = spark.range(1, 1001).withColumnRenamed("id", "k")
    got = [r.k for r in page(df, ["k"], 100, 50, num_partitions=5).orderBy("k").collect()]
    assert got == list(range(101, 151))
    path = f"{scratch}/export"
    bounded_export(df, ["k"], 123, path, num_partitions=5)
    back = spark.read.parquet(path)
    assert back.count() == 123 and back.agg(F.max("k")).collect()[0][0] == 123


def test_write_by_user_round_trip(spark, scratch):
    util = utility_matrix(sales_interactions(spark, SMALL))
    write_by_user(util, f"{scratch}/by_user")
    assert spark.read.parquet(f"{scratch}/by_user").exceptAll(util).count() == 0


def test_attach_key_round_trip(spark):
    from encore.operators import attach_key
    tracks = dense_index(track_catalogue(spark, SMALL), "recording_msid", "song_id", num_partitions=4)
    ids = tracks.select("song_id").limit(5)
    back = attach_key(ids, tracks).join(tracks.select("song_id", F.col("recording_msid").alias("k")), "song_id")
    assert back.filter(F.col("k") != F.col("recording_msid")).count() == 0


def test_ranked_list_one_row(spark):
    from encore.operators import ranked_list
    top = spark.createDataFrame([(30, 2), (10, 3), (20, 1)], "item_id long, rank int")
    rows = ranked_list(top).collect()
    assert len(rows) == 1 and rows[0].popular_songs == [20, 30, 10]


def test_row_index_dense_when_range_bounds_are_sampled(spark):
    # 300k rows in 6 input partitions: the range partitioner samples only part
    # of each partition, so the numbering must come from one fixed partitioning
    df = spark.range(0, 300_000, numPartitions=6).select(
        ((F.col("id") * 104729) % 300_000).alias("k"), (F.col("id") % 7).alias("v"))
    out = row_index(df, "k", "idx", num_partitions=16)
    assert out.filter(F.col("idx") != F.col("k") + 1).count() == 0
    assert out.agg(F.countDistinct("idx")).collect()[0][0] == 300_000


def test_split_keeps_null_user_group(spark):
    rows = [(None, i) for i in range(10)] + [(1, i) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    train, val = per_user_split(df, "user_id", ["user_id", "item_id"])
    assert train.count() + val.count() == 15
    assert train.filter("user_id is null").count() == 8


def test_min_support_null_item_group(spark):
    rows = [(u, None) for u in range(5)] + [(u, 7) for u in range(2)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    assert min_support(df, 3).count() == 5


def test_stage_counts_approx_close(spark):
    from encore.operators import stage_counts
    util = utility_matrix(sales_interactions(spark, SMALL))
    exact = stage_counts([("u", util)]).collect()[0]
    approx = stage_counts([("u", util)], exact=False).collect()[0]
    assert approx.n_rows == exact.n_rows
    assert abs(approx.n_users - exact.n_users) <= 0.05 * exact.n_users


def test_bounded_export_cap_binding_and_not(spark):
    df = spark.range(1, 501).withColumnRenamed("id", "k")
    assert bounded_export(df, ["k"], 10_000, num_partitions=5).count() == 500
    assert [r.k for r in bounded_export(df, ["k"], 7, num_partitions=5).orderBy("k").collect()] == list(range(1, 8))


def test_page_with_tied_keys_is_layout_independent(spark):
    rows = [(k % 5, k) for k in range(200)]  # 40 rows share each key
    df = spark.createDataFrame(rows, "k long, v long")
    a = page(df, ["k"], 30, 50, num_partitions=5)
    b = page(df.repartition(7, "v"), ["k"], 30, 50, num_partitions=3)
    assert a.count() == 50
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_salt_changes_rows_not_sizes(spark):
    df = spark.createDataFrame([(u, i) for u in range(20) for i in range(u + 1)], "user_id long, item_id long")
    a = tag_split(df, "user_id", ["user_id", "item_id"])
    b = tag_split(df, "user_id", ["user_id", "item_id"], salt="round-2")
    sizes = lambda t: dict(t.filter("is_train").groupBy("user_id").count().collect())
    assert sizes(a) == sizes(b)
    assert a.exceptAll(b).count() > 0


def test_sql_surface_over_registered_views(spark):
    """The original SQL statements run over registered views and agree with the operators."""
    from encore.sources.tables import register_views
    from encore.sources.views import sales_interactions_with_nulls
    register_views(spark, SMALL, ["lineitem"])
    assert spark.sql("SELECT COUNT(*) FROM lineitem").collect()[0][0] == 6000
    sales_interactions_with_nulls(spark, SMALL).createOrReplaceTempView("interactions")
    spark.sql("SELECT * FROM interactions WHERE user_id IS NOT NULL OR item_id IS NOT NULL") \
         .createOrReplaceTempView("noNull")
    distinct = spark.sql("SELECT DISTINCT(*) FROM noNull")
    assert distinct.count() == clean(sales_interactions_with_nulls(spark, SMALL), how="all").count()
    assert spark.sql("SELECT * FROM noNull LIMIT 10").count() == 10


def test_bucketed_tables_join_without_shuffle(spark, scratch, capsys):
    from encore.sources.sinks import write_bucketed_by_user
    util = utility_matrix(sales_interactions(spark, SMALL))
    a = write_bucketed_by_user(util, "encore_bucket_a", f"{scratch}/a", 8)
    b = write_bucketed_by_user(util.groupBy("user_id").count(), "encore_bucket_b", f"{scratch}/b", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path
    try:
        joined = a.join(b, "user_id")
        capsys.readouterr()
        joined.explain("simple")
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert joined.count() == util.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_attach_does_not_fan_out_on_repeated_catalogue_keys(spark):
    tracks = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "recording_msid string, name string")
    idx = dense_index(tracks, "recording_msid", "song_id", num_partitions=4)
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "user_id long, recording_msid string")
    out = attach_index(facts, idx, "recording_msid", id_col="song_id", drop_unmatched=True)
    assert sorted((r.user_id, r.song_id) for r in out.collect()) == [(1, 1), (2, 2)]


def test_hot_key_is_spread_by_its_ties(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = row_index(df, "k", "idx", num_partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 6000
    assert out.agg(F.countDistinct("idx"), F.max("idx")).first()[:] == (30_000, 30_000)
    bad = out.groupBy("k").agg((F.max("idx") - F.min("idx") + 1 - F.count("*")).alias("d")).filter("d <> 0")
    assert bad.count() == 0


def test_page_among_identical_rows_and_nulls(spark):
    rows = [(1, "a")] * 10 + [(1, "b")] * 7 + [(None, "n")] * 5 + [(2, "c")] * 4 + [(None, None)] * 2
    df = spark.createDataFrame(rows, "k long, v string").repartition(4)
    for offset, size in ((0, 6), (3, 9), (6, 11), (20, 50), (0, None), (28, 5)):
        got = page(df, ["k", "v"], offset, size, num_partitions=3).collect()
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        want = order[offset:] if size is None else order[offset:offset + size]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_page_keeps_wide_columns_out_of_the_checkpoint(spark, monkeypatch):
    import encore.sources.sinks as sinks
    seen = []
    real = sinks.row_index
    monkeypatch.setattr(sinks, "row_index", lambda df, *a, **k: seen.append(df.columns) or real(df, *a, **k))
    df = spark.range(50).selectExpr("id AS k", "repeat('x', 1000) AS wide", "map('a', id) AS m")
    assert page(df, ["k"], 10, 5, num_partitions=2).count() == 5
    assert seen and len(seen[0]) == 2


def test_weighted_popularity_beyond_64_bits(spark):
    from encore.operators.popularity import beta_sweep_top_k, popularity_top_k
    util = spark.createDataFrame([(u, 1, 10 ** 10) for u in range(3)] + [(9, 2, 5)], "user_id long, item_id long, total_count long")
    top = popularity_top_k(util, 5, "weighted", 10 ** 9).collect()
    assert [int(r.popularity) for r in top] == [3 * 10 ** 10 * (10 ** 9 + 3), 5 * (10 ** 9 + 1)]
    for beta in (0.5, 0, 2):
        single = [(r.item_id, float(r.popularity)) for r in popularity_top_k(util, 5, "weighted", beta).collect()]
        swept = beta_sweep_top_k(util, [beta], 5, "weighted").orderBy("rank").collect()
        assert [(r.item_id, float(r.popularity)) for r in swept] == single and {float(r.beta) for r in swept} == {beta}
    for measure in ("damped", "weighted"):
        with pytest.raises(ValueError):
            beta_sweep_top_k(util, [1, -1], 5, measure)


def test_cleaning_counts_equal_the_stages(spark):
    from encore.operators import cleaning_counts, deduplicate, stage_counts
    from encore.sources.views import sales_interactions_with_nulls
    raw = sales_interactions_with_nulls(spark, SMALL)
    kept = drop_nulls(raw, ("user_id", "item_id"), how="all")
    dedup = deduplicate(kept)
    util = utility_matrix(drop_nulls(dedup, ("user_id", "item_id"), how="any"))
    stages = [("raw", raw), ("non_null", kept), ("deduplicated", dedup), ("utility", util)]
    assert sorted(map(tuple, cleaning_counts(raw).collect())) == sorted(map(tuple, stage_counts(stages).collect()))
    assert [r.n_rows for r in cleaning_counts(raw.limit(0)).collect()] == [0, 0, 0, 0]
