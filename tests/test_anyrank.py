"""Models of higher rank."""

import random

import pytest

from affinity.operators import anyrank, evaluate
from affinity.schemas import USER_RATING


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(4)
    us = [(rng.uniform(0.2, 1), rng.uniform(0.2, 1)) for _ in range(25)]
    vs = [(rng.uniform(0.5, 3), rng.uniform(-2, 2)) for _ in range(20)]
    rows = [
        (u, m, a[0] * b[0] + a[1] * b[1]) for u, a in enumerate(us) for m, b in enumerate(vs)
    ]
    return spark.createDataFrame(rows, USER_RATING)


@pytest.fixture(scope="module")
def fitted(ratings):
    return anyrank.fit(ratings, rank=2, iterations=20, lam=0.001)


def test_planted_rank_2_is_recovered(ratings, fitted):
    row = anyrank.error(fitted, evaluate.weighted(ratings)).first()
    assert row["rmse"] < 0.05 and row["n"] == 500


def test_equations_hold(ratings, fitted):
    gaps = anyrank.equation_gaps(fitted, ratings, 0.001)
    assert gaps.selectExpr("max(gap)").first()[0] < 1e-4


def test_top_n_equals_brute_force(spark, fitted):
    users = {r["id"]: r["features"] for r in fitted.userFactors.collect()}
    items = {r["id"]: r["features"] for r in fitted.itemFactors.collect()}
    asked = spark.createDataFrame([(3,), (8,), (8,), (999,)], "userId int")
    got = {}
    for r in anyrank.for_users(fitted, asked, 4).orderBy("userId", "rank").collect():
        got.setdefault(r["userId"], []).append(r["movieId"])
    score = lambda u, m: sum(a * b for a, b in zip(users[u], items[m]))
    assert got == {u: sorted(items, key=lambda m: -score(u, m))[:4] for u in (3, 8)}


def test_a_group_beyond_the_bound_is_refused(ratings):
    with pytest.raises(ValueError, match="userId"):
        anyrank.fit(ratings, rank=2, group_rows=10)
