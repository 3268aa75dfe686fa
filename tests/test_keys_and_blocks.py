"""Growing dictionaries, Bloom membership, matrix tiles, hot keys and SQL forms."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.operators.growing import empty_index, grow_index, new_ids, store_growth
from encore.operators.hot_keys import hot_keys, left_join_salted
from encore.operators.indexing import attach_index
from encore.operators.membership import bloom_filter, maybe_members, members, warm_start_members
from encore.operators.support import warm_start_filter
from encore.operators.tiles import from_tiles, tile_sums, times_vector, to_tiles
from encore.plans.catalogue import indexed_tracks, sales_split_utility
from encore.plans.sql_forms import FORMS, register, run_form
from encore.sources.views import sales_interactions_raw

from conftest import SMALL


def _plan(df, capsys):
    capsys.readouterr()
    df.explain("simple")
    return capsys.readouterr().out


# -- growing dictionary ---------------------------------------------------------------------


def test_ids_never_change(spark, scratch):
    keys = lambda *k: spark.createDataFrame([(x, 0) for x in k], "recording_msid string, extra int")
    path = f"{scratch}/index"
    first = {r.recording_msid: r.song_id for r in store_growth(path, keys("b", "d", "d", None), num_partitions=3).collect()}
    assert first == {"b": 1, "d": 2}
    second = {r.recording_msid: r.song_id for r in store_growth(path, keys("a", "b", "c", "c"), num_partitions=3).collect()}
    assert second == {"b": 1, "d": 2, "a": 3, "c": 4}
    third = store_growth(path, keys("a", "d"), num_partitions=3)
    assert {r.recording_msid: r.song_id for r in third.collect()} == second
    assert grow_index(third, keys().limit(0), num_partitions=2).count() == 4


def test_many_arrivals_are_dense(spark):
    rnd, known = random.Random(2), empty_index(spark, "string")
    seen: dict[str, int] = {}
    for _ in range(3):
        batch = [f"k{rnd.randrange(500)}" for _ in range(300)]
        known = grow_index(known, spark.createDataFrame([(b,) for b in batch], "recording_msid string"), num_partitions=4)
        got = {r.recording_msid: r.song_id for r in known.collect()}
        assert sorted(got.values()) == list(range(1, len(got) + 1)) and seen.items() <= got.items() and set(batch) <= set(got)
        fresh = sorted(set(got) - set(seen))
        assert [got[k] for k in fresh] == list(range(len(seen) + 1, len(got) + 1))
        seen = got


def test_bad_dictionaries_are_refused(spark):
    arrivals = spark.createDataFrame([("x",)], "recording_msid string")
    for rows in ([("a", 1), ("b", 3)], [("a", 1), ("b", 1)]):
        with pytest.raises(ValueError):
            new_ids(spark.createDataFrame(rows, "recording_msid string, song_id int"), arrivals, num_partitions=1)
    with pytest.raises(OverflowError):
        new_ids(spark.createDataFrame([("a", (1 << 31) - 1)], "recording_msid string, song_id int"), arrivals, num_partitions=1)


# -- membership -----------------------------------------------------------------------------


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 20_000, 2)
    table = bloom_filter(keys, "id", buckets=64)
    assert table.count() <= 64
    passed = {r.id for r in maybe_members(spark.range(20_000), "id", table, 64).collect()}
    assert passed >= set(range(0, 20_000, 2)) and len(passed) < 10_000 + 500
    assert maybe_members(spark.range(10), "id", bloom_filter(keys.limit(0), "id")).count() == 0


def test_members_are_exact_and_filtered_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([(k % 50 if k % 7 else None, f"v{k}") for k in range(1000)], "k int, v string")
    keys = spark.createDataFrame([(3,), (4,), (None,), (4,), (77,)], "key int")
    for buckets in (1, 64):
        got = Counter(map(tuple, members(df, keys, "k", "key", buckets).collect()))
        assert got == Counter((r.k, r.v) for r in df.collect() if r.k in (3, 4))
    train, val = sales_split_utility(spark, SMALL)
    few = train.where("item_id % 10 = 0 AND user_id % 3 = 0")
    ours, theirs = warm_start_members(val, few), warm_start_filter(val, few)
    assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, theirs.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with sides that are too large to send
    try:
        plan = _plan(warm_start_members(val, few), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # below the exchange of the rows both filters have run
    below = plan[plan.index("Exchange hashpartitioning(user_id"):]
    assert below.index("BroadcastHashJoin") < below.index("Scan parquet") and below.count("__words") >= 2
    users = few.select(F.col("user_id").alias("k")).distinct()
    near = maybe_members(val, "user_id", bloom_filter(users, "k"))
    assert near.count() < 0.6 * val.count()


# -- tiles ----------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(4, 8), (3, 5), (256, 4096)])
def test_tiles_round_trip_and_sums(spark, shape):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 40)), int(rng.integers(0, 60)), float(rng.integers(1, 9))) for _ in range(300)]
    rows += [(7, c, 1.0) for c in range(60)] + [(1000, 5, 2.0), (7, 3, 1.0)]  # a full row, a far one, a repeated entry
    df = spark.createDataFrame([*rows, (None, 1, 1.0), (1, None, 1.0), (1, 1, None)], "user_idx long, item_idx long, weight double").repartition(3)
    size = dict(tile_rows=shape[0], tile_cols=shape[1])
    tiles = to_tiles(df, **size)
    held = tiles.collect()
    assert all(len(t.starts) == shape[0] + 1 and t.starts[-1] == len(t.cols) == len(t.weights) for t in held)
    assert all(list(t.starts) == sorted(t.starts) and max(t.cols) < shape[1] for t in held)
    assert Counter(map(tuple, from_tiles(tiles, **size).collect())) == Counter(rows)
    for axis, at in (("row", 0), ("col", 1)):
        want = Counter()
        for r in rows:
            want[r[at]] += r[2]
        assert {r.idx: r.total for r in tile_sums(tiles, axis, **size).collect()} == dict(want)
    x = {c: float(c % 3) for c in range(0, 60, 2)}
    got = {r.idx: r.value for r in times_vector(tiles, spark.createDataFrame(list(x.items()), "idx long, value double"), **size).collect()}
    dense = Counter()
    for r, c, w in rows:
        dense[r] += w * x.get(c, 0.0)
    assert all(got.get(r, 0.0) == pytest.approx(v) for r, v in dense.items())


def test_tiles_of_nothing(spark):
    tiles = to_tiles(spark.createDataFrame([], "user_idx long, item_idx long, weight double"))
    assert tiles.count() == 0 and from_tiles(tiles).count() == 0 and tile_sums(tiles, "row").count() == 0


# -- hot keys -------------------------------------------------------------------------------


def _skewed(spark, n=9000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 997)
    return spark.range(n).select(hot.cast("int").alias("k"), F.col("id").alias("v"))


def test_hot_keys_are_found(spark):
    assert hot_keys(_skewed(spark), "k") == [5]
    assert hot_keys(_skewed(spark), "k", share=0.9) == []
    assert hot_keys(_skewed(spark).limit(0), "k") == []


def test_salted_join_is_the_join_and_spreads_its_tasks(spark):
    facts, dim = _skewed(spark), spark.range(0, 1200).select((F.col("id") % 1100).cast("int").alias("key"), F.col("id").alias("song_id"))
    out = left_join_salted(facts, dim, "k", "key", ["song_id"], salts=64)
    plain = facts.join(dim, F.col("k") == F.col("key"), "left").select("k", "v", "song_id")
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, plain.collect()))
    for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "false" if "enabled" in key else "-1")
    try:
        single = spark.range(0, 1100).select(F.col("id").cast("int").alias("key"), F.col("id").alias("song_id"))
        per_task = sorted(r["count"] for r in left_join_salted(facts, single, "k", "key", ["song_id"], salts=64)
                          .where("k IS NOT NULL").groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert per_task[-1] <= 2 * per_task[len(per_task) // 2]


def test_salted_attach_equals_attach(spark):
    facts = sales_interactions_raw(spark, SMALL).withColumn("key", F.col("item_id").cast("string"))
    tracks = indexed_tracks(spark, SMALL)
    ours = left_join_salted(facts, tracks.select("recording_msid", "song_id").distinct(), "key", "recording_msid", ["song_id"], salts=8, share=0.005)
    theirs = attach_index(facts, tracks, "key", "recording_msid", "song_id")
    columns = [*facts.columns, "song_id"]
    assert Counter(map(tuple, ours.select(*columns).collect())) == Counter(map(tuple, theirs.select(*columns).collect()))


# -- SQL text -------------------------------------------------------------------------------


def test_forms(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, None), (None, "x"), (0, "y")], "k int, `odd name` string")
    view = register(df, "encore_forms_test")
    got = lambda form, **a: [tuple(r) for r in run_form(spark, form, view=view, **a).collect()]
    assert got("count") == [(5,)]
    assert got("count_distinct", a="k", b="`odd name`") == [(5, 2, 2)]
    assert Counter(got("some_key", a="k", b="`odd name`")) == Counter([(1, None), (1, None), (None, "x"), (0, "y")])
    assert len(got("distinct")) == 4
    assert got("first_rows", n=2) == [(None, None), (None, "x")]
    with pytest.raises(ValueError):
        run_form(spark, "drop", view=view)
    with pytest.raises(Exception):
        run_form(spark, "count", view=f"{view}; DROP VIEW {view}")
    assert set(FORMS) == {"count", "count_distinct", "some_key", "distinct", "first_rows"}
