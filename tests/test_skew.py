"""A user holding a third of all rows is ranked by many tasks, with the same result."""

from pyspark.sql import functions as F

from encore.operators.split import _N, _RN, rank_within_user, tag_split


def _skewed(spark):
    hot = spark.range(0, 6000).select(F.lit(0).cast("long").alias("user_id"), F.col("id").alias("item_id"))
    rest = spark.range(0, 12000).select((F.col("id") % 400 + 1).alias("user_id"), F.col("id").alias("item_id"))
    return hot.unionByName(rest)


def test_hot_user_is_spread_over_tasks(spark):
    df = _skewed(spark)
    ranked = rank_within_user(df, "user_id", ["user_id", "item_id"])
    # rows this few would all be coalesced into one partition
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = (ranked.filter("user_id = 0")
                          .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 0.5 * 6000
    # ranks of the hot user are exactly 1..n and n is the full count
    stats = ranked.filter("user_id = 0").agg(F.min(_RN), F.max(_RN), F.countDistinct(_RN), F.max(_N)).collect()[0]
    assert tuple(stats) == (1, 6000, 6000, 6000)


def test_all_plans_agree_on_skewed_input(spark):
    df = _skewed(spark)
    cols = ["user_id", "item_id", "is_train"]
    plain = tag_split(df, "user_id", ["user_id", "item_id"], slices=1).select(*cols)
    heavy = tag_split(df, "user_id", ["user_id", "item_id"]).select(*cols)
    fallback = (rank_within_user(df, "user_id", ["user_id", "item_id"], slices=100)
                .select("user_id", "item_id", (5 * F.col(_RN) <= 4 * (F.col(_N) + 1)).alias("is_train")))
    for other in (heavy, fallback):
        assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0
