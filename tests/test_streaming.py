"""The incremental utility matrix equals the batch one."""

from encore.operators.utility import utility_matrix
from encore.sources.views import event_interactions
from encore.streaming import read_utility, start_incremental_utility

from conftest import ROOT, SMALL


def test_incremental_utility_matches_batch(spark, scratch):
    events = event_interactions(spark, SMALL).select("user_id", "item_id")
    src = f"{scratch}/src"
    first, second = events.randomSplit([0.5, 0.5], seed=1)
    first.write.parquet(f"{src}/part=1")
    q = start_incremental_utility(spark, src, "user_id long, item_id int", f"{scratch}/sink",
                                  f"{scratch}/ckpt")
    q.awaitTermination()
    second.write.parquet(f"{src}/part=2")
    q = start_incremental_utility(spark, src, "user_id long, item_id int", f"{scratch}/sink",
                                  f"{scratch}/ckpt")
    q.awaitTermination()
    got = read_utility(spark, f"{scratch}/sink")
    want = utility_matrix(events)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replayed_batch_is_idempotent(spark, scratch):
    """A batch written twice (a retried micro-batch) replaces its own output."""
    from encore.streaming.utility_stream import read_utility
    events = event_interactions(spark, SMALL).select("user_id", "item_id")
    sink = f"{scratch}/sink"
    for _ in range(2):  # the same batch id written twice, as a retry would
        utility_matrix(events).write.mode("overwrite").parquet(f"{sink}/batch_id=0")
    got = read_utility(spark, sink)
    want = utility_matrix(events)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


INGEST = """
import sys
from encore.session import build_session
from encore.streaming import start_incremental_utility
spark = build_session("local[2]", shuffle_partitions=2, conf={"spark.checkpoint.dir": sys.argv[1] + "/shared"})
start_incremental_utility(spark, sys.argv[1] + "/src", "user_id long, item_id int", sys.argv[1] + "/sink",
                          sys.argv[1] + "/progress").awaitTermination()
spark.stop()
"""


def test_restart_in_a_new_session_counts_once(spark, scratch):
    import os
    import subprocess
    import sys
    for n in range(2):
        spark.createDataFrame([(1, 10 + n), (2, 1)], "user_id long, item_id int").write.parquet(f"{scratch}/src/part={n}")
        subprocess.run([sys.executable, "-c", INGEST, scratch], env={**os.environ, "PYTHONPATH": ROOT}, check=True, timeout=200,
                       capture_output=True)
    got = sorted(map(tuple, read_utility(spark, f"{scratch}/sink").select("user_id", "item_id", "total_count").collect()))
    assert got == [(1, 10, 1), (1, 11, 1), (2, 1, 2)]


def test_two_sinks_each_get_everything(spark, scratch):
    import pytest
    spark.createDataFrame([(1, 1), (2, 2)], "user_id long, item_id int").write.parquet(f"{scratch}/src/part=0")
    for name in ("a", "b"):
        start_incremental_utility(spark, f"{scratch}/src", "user_id long, item_id int", f"{scratch}/{name}",
                                  f"{scratch}/progress-{name}").awaitTermination()
        assert read_utility(spark, f"{scratch}/{name}").count() == 2
    with pytest.raises(ValueError, match="checkpoint"):
        start_incremental_utility(spark, f"{scratch}/src", "user_id long, item_id int", f"{scratch}/c", "")
