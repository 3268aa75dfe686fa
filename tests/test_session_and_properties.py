"""Session sizing and randomized split invariants."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from encore.operators.split import per_user_split
from encore.session import cluster_conf


def test_cluster_conf_scales():
    small = cluster_conf(10 * 2**30, 64)
    big = cluster_conf(100 * 2**40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    # 100 TB at 256 MB a partition, no ceiling
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(min_value=1, max_value=25), min_size=1, max_size=12),
       slices=st.sampled_from([1, 3, 1024]))
def test_split_rule_random_users(spark, sizes, slices):
    rows = [(u, i) for u, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    train, val = per_user_split(df, "user_id", ["user_id", "item_id"], slices=slices)
    got = dict(train.groupBy("user_id").count().collect())
    for u, n in enumerate(sizes):
        assert got.get(u, 0) == max(r for r in range(n + 1) if 5 * r <= 4 * (n + 1))
    assert train.count() + val.count() == len(rows)
    assert train.unionByName(val).exceptAll(df).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       parts=st.integers(min_value=1, max_value=7))
def test_row_index_dense_random(spark, keys, parts):
    from pyspark.sql import functions as F
    from encore.operators.indexing import row_index
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int")
    rows = row_index(df, "k", "idx", num_partitions=parts).collect()
    assert sorted(r.idx for r in rows) == list(range(1, len(keys) + 1))
    by_idx = sorted(rows, key=lambda r: r.idx)
    assert [r.k for r in by_idx] == sorted(keys)


def test_a_cluster_must_name_its_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace
    import pytest
    from encore import session
    conf = SimpleNamespace(get=lambda *a: None)

    def fake(master):
        made = []
        sc = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: made[-1] if made else None,
                             setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=sc, conf=conf)

    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake(master))
    assert session.ensure_checkpoint_dir(fake("local[4]"))
