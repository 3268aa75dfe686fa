"""Hand-computed fixture: utility, popularity forms, labels and ranking metrics."""

import pytest
from pyspark.sql import functions as F

from encore.operators import (
    label_arrays, label_lists, popularity, popularity_top_k, ranking_metrics,
    shared_list_metrics, utility_matrix,
)

A, B, C = 1, 2, 3
PAIRS = [(1, A)] * 2 + [(1, B)] + [(2, A)] + [(2, B)] * 3 + [(3, A)] + [(4, C)] * 5


@pytest.fixture()
def util(spark):
    df = spark.createDataFrame(PAIRS, "user_id long, item_id long")
    return utility_matrix(df)


def _as_dict(df, key="item_id", val="popularity"):
    return {r[key]: r[val] for r in df.collect()}


def test_utility(util):
    got = {(r.user_id, r.item_id): r.total_count for r in util.collect()}
    assert got == {(1, A): 2, (1, B): 1, (2, A): 1, (2, B): 3, (3, A): 1, (4, C): 5}


def test_popularity_forms(util):
    damped = _as_dict(popularity(util, "damped", 1))
    assert damped[A] == pytest.approx(1.0)
    assert damped[B] == pytest.approx(4 / 3)
    assert damped[C] == pytest.approx(2.5)
    assert _as_dict(popularity(util, "weighted", 0)) == {A: 12, B: 8, C: 5}
    assert _as_dict(popularity(util, "weighted", 1)) == {A: 16, B: 12, C: 10}


def test_top_k_order(util):
    top = popularity_top_k(util, 100, "damped", 1).orderBy("rank")
    assert [r.item_id for r in top.collect()] == [C, B, A]
    top = popularity_top_k(util, 100, "weighted", 0).orderBy("rank")
    assert [r.item_id for r in top.collect()] == [A, B, C]


def test_labels(util):
    arrays = {r.user_id: r.actual_songs for r in label_arrays(label_lists(util, 100), 100).collect()}
    assert arrays == {1: [A, B], 2: [B, A], 3: [A], 4: [C]}


def test_label_ties_larger_item_first(spark):
    util = spark.createDataFrame([(1, 5, 2), (1, 9, 2), (1, 7, 3)], "user_id long, item_id long, total_count long")
    arrays = label_arrays(label_lists(util, 100), 100).collect()
    assert arrays[0].actual_songs == [7, 9, 5]


@pytest.mark.parametrize("k,exp", [
    (100, (0.625, 0.7217132018086354, 0.015)),
    (2, (0.375, 0.4434264036172708, 0.375)),
])
def test_metrics_shared_list(spark, util, k, exp):
    top = spark.createDataFrame([(C, 1), (B, 2), (A, 3)], "item_id long, rank int")
    m = shared_list_metrics(top, label_lists(util, 100), k).collect()[0]
    assert m.map_at_k == pytest.approx(exp[0], abs=1e-12)
    assert m.ndcg_at_k == pytest.approx(exp[1], abs=1e-12)
    assert m.precision_at_k == pytest.approx(exp[2], abs=1e-12)
    assert m.n_users == 4


@pytest.mark.parametrize("k,exp", [
    (100, (0.625, 0.7217132018086354, 0.015)),
    (2, (0.375, 0.4434264036172708, 0.375)),
])
def test_metrics_per_user_lists(spark, util, k, exp):
    preds = spark.createDataFrame([(u, i, r) for u in (1, 2, 3, 4) for r, i in ((1, C), (2, B), (3, A))],
                                  "user_id long, item_id long, rank int")
    m = ranking_metrics(preds, label_lists(util, 100), k, users="recommended").collect()[0]
    assert (m.map_at_k, m.ndcg_at_k, m.precision_at_k) == pytest.approx(exp, abs=1e-12)


def test_metrics_empty_labels_count_as_zero(spark):
    preds = spark.createDataFrame([(1, 10, 1), (2, 20, 1)], "user_id long, item_id long, rank int")
    labels = spark.createDataFrame([(1, 10, 1)], "user_id long, item_id long, label_rank int")
    m = ranking_metrics(preds, labels, 10, users="recommended").collect()[0]
    assert m.map_at_k == pytest.approx(0.5)
    assert m.n_users == 2


def test_metrics_match_spark_ml(spark, util):
    """Cross-check against pyspark.ml's RankingEvaluator on the same lists."""
    from pyspark.ml.evaluation import RankingEvaluator
    labels = label_lists(util, 100)
    preds = spark.createDataFrame([(u, i, r) for u in (1, 2, 3, 4) for r, i in ((1, C), (2, B), (3, A))],
                                  "user_id long, item_id long, rank int")
    ours = ranking_metrics(preds, labels, 2, users="recommended").collect()[0]
    lab = label_arrays(labels, 100).select("user_id", F.col("actual_songs").cast("array<double>").alias("label"))
    pred = spark.createDataFrame([(u, [float(C), float(B), float(A)]) for u in (1, 2, 3, 4)],
                                 "user_id long, prediction array<double>")
    joined = pred.join(lab, "user_id")
    for metric, val in (("meanAveragePrecisionAtK", ours.map_at_k), ("ndcgAtK", ours.ndcg_at_k),
                        ("precisionAtK", ours.precision_at_k)):
        ev = RankingEvaluator(metricName=metric, k=2, labelCol="label", predictionCol="prediction")
        assert ev.evaluate(joined) == pytest.approx(val, abs=1e-12)


def test_beta_sweep_equals_separate_runs(spark):
    from encore.operators import beta_sweep_top_k
    from encore.sources.views import sales_interactions
    from conftest import SMALL
    util = utility_matrix(sales_interactions(spark, SMALL))
    sweep = beta_sweep_top_k(util, [10, 1000], 20, "damped")
    for b in (10, 1000):
        one = popularity_top_k(util, 20, "damped", b).select("item_id", "rank")
        part = sweep.filter(F.col("beta") == float(b)).select("item_id", "rank")
        assert one.exceptAll(part).count() == 0 and part.exceptAll(one).count() == 0
