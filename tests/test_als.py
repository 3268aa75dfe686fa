"""ALS invariants: what must hold of any model, and that a fit is reproducible."""

import os
import subprocess
import sys

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import als as als_ops
from encore.operators.als import als_grid, evaluate_als, fit_als, recommend, recommendation_lists
from encore.operators.labels import label_lists
from encore.plans.catalogue import _metric_checks, events_split_utility

from conftest import MEDIUM, ROOT, SMALL


def test_als_recommendations_invariants(spark):
    train, val = events_split_utility(spark, SMALL)
    model = fit_als(train, rank=8, reg=0.1, alpha=1.0, max_iter=5, seed=7, num_blocks=4)
    recs = recommend(model, val.select("user_id"), 10)
    per_user = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("d"))
    assert per_user.filter("n > 10 or n != d").count() == 0
    w = Window.partitionBy("user_id").orderBy("rank")
    bad = recs.withColumn("prev", F.lag("rating").over(w)).filter(F.col("prev") < F.col("rating"))
    assert bad.count() == 0
    # only users known to the model get recommendations
    assert recs.join(train.select("user_id").distinct(), "user_id", "left_anti").count() == 0
    again = recommend(fit_als(train, rank=8, reg=0.1, alpha=1.0, max_iter=5, seed=7, num_blocks=4), val.select("user_id"), 10)
    assert recs.select("user_id", "item_id", "rank").exceptAll(again.select("user_id", "item_id", "rank")).count() == 0
    lists = recommendation_lists(recs).collect()
    assert all(len(r.song_id) <= 10 for r in lists)


def test_als_metrics_in_range(spark):
    train, val = events_split_utility(spark, SMALL)
    model = fit_als(train, rank=8, reg=0.1, alpha=1.0, max_iter=5, seed=7, num_blocks=4)
    m = evaluate_als(model, val.select("user_id"), label_lists(val, 100), 100).collect()[0]
    for v in (m.map_at_k, m.ndcg_at_k, m.precision_at_k):
        assert 0.0 <= v <= 1.0
    assert m.n_users > 0


FIT = """
import sys, tempfile
from encore.session import build_session
spark = build_session(f"local[{sys.argv[1]}]", shuffle_partitions=int(sys.argv[1]) * 3,
                      conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="encore-als-")})
from encore.operators.als import fit_als, recommend
from encore.plans.catalogue import sales_split_utility
train, _ = sales_split_utility(spark, sys.argv[2])
model = fit_als(train, rank=8, reg=0.2, alpha=1.0, max_iter=3, seed=42, num_blocks=5)
rows = recommend(model, train.select("user_id"), 10).select("user_id", "rank", "item_id").collect()
print("LISTS", len(rows), hash(tuple(sorted(map(tuple, rows)))))
spark.stop()
"""


def test_fit_does_not_depend_on_the_number_of_cores():
    said = []
    for cores in ("2", "4"):
        env = {**os.environ, "PYTHONPATH": ROOT, "PYTHONHASHSEED": "0"}
        run = subprocess.run([sys.executable, "-c", FIT, cores, MEDIUM], env=env, capture_output=True, text=True, timeout=300)
        said.append([x for x in run.stdout.splitlines() if x.startswith("LISTS")])
    assert said[0] and said[0] == said[1]


def test_grid_releases_its_models(spark):
    train, val = events_split_utility(spark, SMALL)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = als_grid(train, val.select("user_id"), label_lists(val, 10), [4], [0.1, 0.2], [1.0], 10, 2, seed=1, num_blocks=3)
    assert out.count() == 2 and len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    one = fit_als(train, rank=4, reg=0.1, alpha=1.0, max_iter=2, seed=1, num_blocks=3)
    m = evaluate_als(one, val.select("user_id"), label_lists(val, 10), 10).first()
    row = out.filter("reg_param = 0.1").first()
    assert abs(row.map_at_k - m.map_at_k) < 1e-9 and row.n_users == m.n_users


def _made(spark):
    rows = [(u, i, 1 + (u * i) % 3) for u in range(12) for i in range(9) if (u + 2 * i) % 4]
    return spark.createDataFrame(rows, "user_id long, item_id int, total_count long")


def test_grid_scores_recommendations_that_are_written_once(spark, monkeypatch):
    util = _made(spark)
    seen, evaluate = [], als_ops.evaluate_als

    def spy(model, users, labels, k, user_col, item_col, recs=None):
        seen.append(recs is not None and bool(recs.inputFiles()))
        return evaluate(model, users, labels, k, user_col, item_col, recs)

    monkeypatch.setattr(als_ops, "evaluate_als", spy)
    out = als_grid(util, util.select("user_id"), label_lists(util, 5), [3], [0.1, 0.2], [1.0], 5, 1, seed=1, num_blocks=2)
    assert out.count() == 2 and seen == [True, True]


def test_metric_checks_recommend_once(spark, monkeypatch):
    util = _made(spark)
    model = fit_als(util, rank=3, reg=0.1, alpha=1.0, max_iter=1, seed=1, num_blocks=2)
    calls, plain = [], als_ops.recommend
    monkeypatch.setattr(als_ops, "recommend", lambda *a, **b: calls.append(1) or plain(*a, **b))
    row = _metric_checks(model, util, util, dict(reg=0.1, alpha=1.0)).first()
    assert len(calls) == 1 and row.n_users == 12 and all(row[c] for c in row.asDict())
