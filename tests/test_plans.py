"""Plan properties the design relies on (see PLANS.md), checked on physical plans."""

import re

from encore.operators import label_lists, popularity_top_k, row_index, utility_matrix
from encore.plans.catalogue import sales_split_utility
from encore.sources.views import sales_interactions

from conftest import SMALL


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain("simple")
    return capsys.readouterr().out


def test_split_is_lazy_and_reads_its_source_once(spark, capsys):
    from encore.operators import per_user_split
    source = sales_interactions(spark, SMALL)  # opening the tables reads their schemas
    spark.sparkContext.setJobGroup("split-build", "")
    out, _ = per_user_split(source, "user_id", ["user_id", "item_id", "l_orderkey", "l_linenumber"])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("split-build")) == []
    spark.sparkContext.setJobGroup("tests", "")
    out.collect()
    final = plan_of(out, capsys).split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 2  # orders and lineitem, once each
    assert "ReusedExchange" in final


def test_split_shuffles_rows_on_user_and_slice(spark, capsys):
    from encore.plans.catalogue import q_split_train
    plan = plan_of(q_split_train(spark, SMALL), capsys)
    rows = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "__encore_b" in e]
    assert rows and all("__encore_uv" in e for e in rows)


def test_evaluation_reads_its_source_once(spark, capsys):
    from encore.plans.catalogue import q_popularity_eval
    plan = plan_of(q_popularity_eval(spark, SMALL), capsys)
    # the split and both utilities are one written table
    assert "lineitem" not in plan and "split-utility" in plan


def test_split_utility_labels_need_one_shuffle(spark, capsys):
    _, val = sales_split_utility(spark, SMALL)
    plan = plan_of(label_lists(val, 100), capsys)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len([e for e in exchanges if e.startswith("user_id")]) == 1 and len(exchanges) == 1
    assert "WindowGroupLimit" in plan


def test_per_user_top_k_limits_before_shuffle(spark, capsys):
    util = utility_matrix(sales_interactions(spark, SMALL))
    plan = plan_of(label_lists(util, 10), capsys)
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning(user_id"))
    assert "Partial" in plan[partial:partial + 200]


def test_global_top_k_is_take_ordered(spark, capsys):
    util = utility_matrix(sales_interactions(spark, SMALL))
    plan = plan_of(popularity_top_k(util, 100, "weighted", 0), capsys)
    assert "TakeOrderedAndProject(limit=100" in plan


def test_scans_are_pruned(spark, capsys):
    util = utility_matrix(sales_interactions(spark, SMALL))
    plan = plan_of(util, capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in schemas
    assert all("l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)


def test_row_index_numbered_side_has_no_exchange(spark, capsys):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = plan_of(row_index(df, "k", "idx", num_partitions=8), capsys)
    stream_side = plan.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert "Exchange" not in stream_side and "Scan ExistingRDD" in stream_side
