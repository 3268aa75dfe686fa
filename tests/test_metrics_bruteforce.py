"""Ranking metrics against a brute-force implementation of the definitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from encore.operators import ranking_metrics, shared_list_metrics


def brute(preds: dict, labels: dict, k: int, users: list) -> tuple:
    aps, ndcgs, ps = [], [], []
    for u in users:
        p = preds.get(u, [])
        lab = set(labels.get(u, []))
        n = min(len(p), k)
        hits, ap, dcg = 0, 0.0, 0.0
        for j in range(n):
            if p[j] in lab:
                hits += 1
                ap += hits / (j + 1)
                dcg += 1 / math.log(j + 2)
        m = min(len(lab), k)
        idcg = sum(1 / math.log(j + 2) for j in range(m))
        aps.append(ap / m if m else 0.0)
        ndcgs.append(dcg / idcg if m else 0.0)
        ps.append(hits / k)
    n = len(users)
    return (sum(aps) / n, sum(ndcgs) / n, sum(ps) / n)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_per_user_metrics_random(spark, seed):
    rnd = random.Random(seed)
    items = list(range(40))
    preds = {u: rnd.sample(items, rnd.randint(0, 15)) for u in range(30)}
    labels = {u: rnd.sample(items, rnd.randint(0, 12)) for u in range(5, 40)}
    k = rnd.choice([3, 5, 10, 20])
    pdf = spark.createDataFrame([(u, i, r + 1) for u, p in preds.items() for r, i in enumerate(p)] or [(0, 0, 1)],
                                "user_id long, item_id long, rank int")
    if not any(preds.values()):
        pytest.skip("no predictions drawn")
    ldf = spark.createDataFrame([(u, i) for u, ls in labels.items() for i in ls], "user_id long, item_id long")
    users_rec = sorted(u for u, p in preds.items() if p)
    got = ranking_metrics(pdf, ldf, k, users="recommended").collect()[0]
    assert (got.map_at_k, got.ndcg_at_k, got.precision_at_k) == pytest.approx(
        brute(preds, labels, k, users_rec), abs=1e-12)
    assert got.n_users == len(users_rec)
    users_lab = sorted(u for u, ls in labels.items() if ls)
    got = ranking_metrics(pdf, ldf, k, users="all").collect()[0]
    assert (got.map_at_k, got.ndcg_at_k, got.precision_at_k) == pytest.approx(
        brute(preds, labels, k, users_lab), abs=1e-12)


@pytest.mark.parametrize("seed", [4, 5])
def test_shared_list_metrics_random_groups(spark, seed):
    rnd = random.Random(seed)
    items = list(range(30))
    lists = {g: rnd.sample(items, 10) for g in (1, 2, 3)}
    labels = {u: rnd.sample(items, rnd.randint(1, 8)) for u in range(25)}
    k = 6
    top = spark.createDataFrame([(g, i, r + 1) for g, p in lists.items() for r, i in enumerate(p)],
                                "g int, item_id long, rank int")
    ldf = spark.createDataFrame([(u, i) for u, ls in labels.items() for i in ls], "user_id long, item_id long")
    got = {r.g: r for r in shared_list_metrics(top, ldf, k, group_cols=["g"]).collect()}
    for g, p in lists.items():
        exp = brute({u: p for u in labels}, labels, k, sorted(labels))
        assert (got[g].map_at_k, got[g].ndcg_at_k, got[g].precision_at_k) == pytest.approx(exp, abs=1e-12)
        assert got[g].n_users == len(labels)


def test_als_metrics_match_ranking_evaluator(spark):
    from pyspark.ml.evaluation import RankingEvaluator
    from encore.operators.als import fit_als, recommend, recommendation_lists
    from encore.operators.labels import label_arrays, label_lists
    from encore.plans.catalogue import events_split_utility
    from conftest import SMALL
    train, val = events_split_utility(spark, SMALL)
    model = fit_als(train, rank=6, reg=0.1, alpha=1.0, max_iter=4, seed=3, num_blocks=4)
    recs = recommend(model, val.select("user_id"), 20)
    labels = label_lists(val, 100)
    ours = ranking_metrics(recs, labels.select(F.col("user_id").cast("int").alias("user_id"),
                                               F.col("item_id").cast("int").alias("item_id")),
                           20, users="recommended").collect()[0]
    pred = recommendation_lists(recs).select("user_id", F.col("song_id").cast("array<double>").alias("prediction"))
    lab = label_arrays(labels, 100).select(F.col("user_id").cast("int").alias("user_id"),
                                      F.col("actual_songs").cast("array<double>").alias("label"))
    joined = pred.join(lab, "user_id", "left").select(
        "prediction", F.coalesce("label", F.array().cast("array<double>")).alias("label"))
    for metric, val_ in (("meanAveragePrecisionAtK", ours.map_at_k), ("ndcgAtK", ours.ndcg_at_k),
                         ("precisionAtK", ours.precision_at_k)):
        ev = RankingEvaluator(metricName=metric, k=20, labelCol="label", predictionCol="prediction")
        assert ev.evaluate(joined) == pytest.approx(val_, abs=1e-12)
