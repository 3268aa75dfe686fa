"""ALS factors against their normal equations, and pruned top-k lists against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.operators.als import fit_als, prepare_ratings, recommend
from encore.operators.als_solution import check_last_half_step, gram, normal_residuals
from encore.operators.als_topk import recommend_pruned
from encore.plans.catalogue import events_split_utility

from conftest import SMALL

REG, ALPHA = 0.1, 2.0


@pytest.fixture(scope="module")
def fitted(spark):
    train, _ = events_split_utility(spark, SMALL)
    return train, fit_als(train, rank=6, reg=REG, alpha=ALPHA, max_iter=4, seed=3, num_blocks=3)


def test_gram_is_the_sum_of_outer_products(fitted):
    _, model = fitted
    y = np.array([r.features for r in model.itemFactors.collect()], np.float64)
    assert np.allclose(np.array(gram(model.itemFactors).first().gram).reshape(6, 6), y.T @ y)


def test_residuals_match_dense_algebra(spark, fitted):
    train, model = fitted
    x = {r.id: np.array(r.features, np.float64) for r in model.userFactors.collect()}
    y = {r.id: np.array(r.features, np.float64) for r in model.itemFactors.collect()}
    g = sum(np.outer(v, v) for v in y.values())
    rows = prepare_ratings(train).collect()
    # any factors will do: the users' own, and others that solve nothing
    for scale in (1.0, 1.1):
        moved = model.userFactors.select("id", F.transform("features", lambda v: v * scale).alias("features"))
        got = {r.user_id: r.residual for r in normal_residuals(train, moved, model.itemFactors, REG, ALPHA).collect()}
        assert set(got) == {r.user_id for r in rows}
        for u in sorted(got)[:20]:
            mine = [(y[r.item_id], float(r.total_count)) for r in rows if r.user_id == u]
            more = sum(ALPHA * abs(r) * np.outer(v, v) for v, r in mine)
            right = sum((1 + ALPHA * r) * v for v, r in mine if r > 0)
            v = (x[u] * np.float32(scale)).astype(np.float32).astype(np.float64)
            gap = np.linalg.norm((g + more + REG * len(mine) * np.eye(6)) @ v - right)
            assert got[u] == pytest.approx(gap / (np.linalg.norm(g @ v) + np.linalg.norm(more @ v) + np.linalg.norm(right)), abs=1e-6)


def test_a_fit_is_a_solution_and_other_factors_are_not(spark, fitted):
    train, model = fitted
    out = check_last_half_step(model, train, REG, ALPHA).collect()
    assert out and all(r.solved for r in out)
    assert not any(r.solved for r in check_last_half_step(model, train, REG * 1.5, ALPHA).collect())
    noise = model.userFactors.select("id", F.transform("features", lambda v: v + F.lit(0.01)).alias("features"))
    assert all(r.residual > 1e-4 for r in normal_residuals(train, noise, model.itemFactors, REG, ALPHA).collect())
    # the items' half step came before the last one
    items = normal_residuals(train, model.itemFactors, model.userFactors, REG, ALPHA, "item_id", "user_id").agg(F.max("residual")).first()[0]
    assert items > 1e-4


def test_negative_and_missing_ratings(spark, fitted):
    _, model = fitted
    known = sorted(r.id for r in model.itemFactors.collect())
    user = model.userFactors.first().id
    rows = [(user, known[0], -2.0), (user, known[1], 1.0), (user, 10 ** 6, 1.0), (10 ** 6, known[0], 1.0), (None, known[0], 1.0)]
    out = normal_residuals(spark.createDataFrame(rows, "user_id int, item_id int, total_count double"), model.userFactors, model.itemFactors, REG, ALPHA).collect()
    assert [(r.user_id, r.n_ratings) for r in out] == [(user, 2)] and out[0].residual > 0
    empty = spark.createDataFrame([], "user_id int, item_id int, total_count double")
    assert normal_residuals(empty, model.userFactors, model.itemFactors, REG, ALPHA).count() == 0


def _factors(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in f]) for i, f in rows], "id int, features array<float>")


@pytest.mark.parametrize("block,limit", [(4, 1 << 20), (4, 1), (1000, 1 << 20)])
def test_pruned_lists_are_exact(spark, block, limit):
    rng = np.random.default_rng(block + limit)
    items = [(100 + k, rng.normal(size=5) * np.exp(rng.normal())) for k in range(90)] + [(300, np.zeros(5)), (301, np.zeros(5))]
    users = [(k, rng.normal(size=5)) for k in range(40)] + [(50, np.zeros(5))]
    out = recommend_pruned(_factors(spark, users), _factors(spark, items), 7, num_partitions=3, block_items=block, round_bytes=limit)
    got, scored = {}, {}
    for r in sorted(out.collect(), key=lambda r: (r.user_id, r.rank)):
        got.setdefault(r.user_id, []).append(r.item_id)
        scored[r.user_id] = r.n_scored
    f32 = lambda v: np.asarray(v, np.float32).astype(np.float64)
    for u, x in users:
        want = sorted(((-float(f32(x) @ f32(y)), i) for i, y in items))[:7]
        assert got[u] == [i for _, i in want]
    assert all(n <= len(items) for n in scored.values())
    if block == 4:
        assert sum(scored.values()) < 0.8 * len(items) * len(users)


def test_pruned_lists_equal_sparks(spark, fitted):
    _, model = fitted
    theirs = {}
    for r in recommend(model, None, 10).collect():
        theirs.setdefault(r.user_id, []).append((r.rank, r.rating, r.item_id))
    ours = {}
    for r in recommend_pruned(model.userFactors, model.itemFactors, 10, num_partitions=2, block_items=8).collect():
        ours.setdefault(r.user_id, []).append((r.rank, r.rating, r.item_id))
    assert set(ours) == set(theirs)
    for u in ours:
        a, b = sorted(ours[u]), sorted(theirs[u])
        assert np.allclose([r for _, r, _ in a], [r for _, r, _ in b], atol=1e-5)
        assert all(x[2] == y[2] or abs(x[1] - y[1]) < 1e-5 for x, y in zip(a, b, strict=True))


def test_pruned_edges(spark):
    users, items = _factors(spark, [(1, [1, 0])]), _factors(spark, [(7, [2, 0]), (8, [2, 0])])
    assert [(r.item_id, r.rank) for r in recommend_pruned(users, items, 5, num_partitions=2).collect()] == [(7, 1), (8, 2)]
    assert recommend_pruned(users.limit(0), items, 5, num_partitions=2).count() == 0
    assert recommend_pruned(users, items.limit(0), 5, num_partitions=2).count() == 0


def test_ratings_are_summed_by_plain_sums_and_weighed_once(spark, fitted):
    train, model = fitted
    plan = normal_residuals(train, model.userFactors, model.itemFactors, REG, ALPHA)._jdf.queryExecution().optimizedPlan().toString()
    sums = [x for x in plan.splitlines() if "Aggregate [__row" in x]
    assert sums and not any("summarizer" in x.lower() or "AggregateMetrics" in x for x in sums)
    # the product of both factors is below the rows' places, not in them
    assert plan.index("Generate posexplode") < plan.index("aggregate(zip_with(__y")
