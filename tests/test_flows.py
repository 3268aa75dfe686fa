"""End-to-end flow, lazily and with stages materialized in the checkpoint folder."""

from encore.plans.catalogue import SPLIT_KEYS
from encore.plans.flows import als_report, popularity_report, prepare
from encore.sources.views import sales_interactions, track_catalogue

from conftest import SMALL


def test_flow_materialized_equals_lazy(spark):
    args = dict(split_keys=SPLIT_KEYS, support=3, num_partitions=4)
    lazy = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL), **args)
    mat = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL),
                  materialize_stages=True, **args)
    assert lazy.utility_train.exceptAll(mat.utility_train).count() == 0
    a = popularity_report(lazy, 100, "damped", 500000).collect()[0]
    b = popularity_report(mat, 100, "damped", 500000).collect()[0]
    assert a == b and a.n_users > 0


def test_flow_als_report(spark):
    p = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL),
                split_keys=SPLIT_KEYS, support=3, num_partitions=4)
    m = als_report(p, rank=4, reg=0.1, alpha=1.0, max_iter=3, seed=1, num_blocks=4, k=20).collect()[0]
    assert 0.0 <= m.map_at_k <= 1.0 and m.n_users > 0


def test_all_thresholds_in_one_preparation(spark):
    args = dict(split_keys=SPLIT_KEYS, num_partitions=4)
    many = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL), support=(3, 10), materialize_stages=True, **args)
    one = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL), support=10, **args)
    assert list(many.filtered) == [3, 10] and many.filtered_train.count() == many.filtered[3][0].count()
    for a, b in zip(many.filtered[10], one.filtered[10], strict=True):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_released_tables_are_deleted(spark):
    import glob
    import os
    p = prepare(sales_interactions(spark, SMALL), track_catalogue(spark, SMALL), split_keys=SPLIT_KEYS, num_partitions=4,
                materialize_stages=True)
    paths = [t._encore_path.removeprefix("file:") for t in p.tables]
    assert len(paths) == 2 and all(glob.glob(f"{x}/*.parquet") for x in paths)
    p.release()
    assert not any(os.path.exists(x) for x in paths)
