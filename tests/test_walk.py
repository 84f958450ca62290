"""Fits that walk through blocks of factors give the models of the other layouts, and move next to nothing."""

import random

import pytest

from affinity.operators import evaluate, factor, walk
from affinity.schemas import USER_RATING

WALK = {"whole": factor.Limits(walk_pairs=0), "split": factor.Limits(walk_pairs=0, group_rows=20)}


def ratings(spark, seed=5, n=900):
    """With a hot user and item, copies, null ids and null ratings."""
    rng = random.Random(seed)
    rows = [(rng.randrange(40), rng.randrange(30), rng.randrange(1, 11) / 2) for _ in range(n)]
    rows += [(rng.randrange(40), 3, 4.0) for _ in range(n // 2)] + [(7, rng.randrange(30), 2.5) for _ in range(n // 5)]
    rows += [(None, 2, 3.0), (None, 5, 1.0), (4, None, 2.0), (None, None, 1.0), (90, 91, None), (4, 5, None)]
    return spark.createDataFrame(rows, USER_RATING)


def same(a, b):
    def rows(df):
        columns = sorted(df.columns, key=lambda c: (c not in ("userId", "movieId", "lambda", "iterations"), c))
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, x or 0) for x in r])

    a, b = rows(a), rows(b)
    assert len(a) == len(b) > 0
    assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-8) for p, q in zip(a, b, strict=True) for x, y in zip(p, q, strict=True)), (a, b)


@pytest.mark.parametrize("limits", WALK.values(), ids=WALK)
def test_a_walked_grid_is_the_same(spark, workspace, limits):
    df, rows = ratings(spark), evaluate.weighted(ratings(spark, 9, 300))
    plain = factor.fit_grid(workspace, df, (0.001, 0.1), (2, 3), name="plain_grid")
    walked = factor.fit_grid(workspace, df, (0.001, 0.1), (2, 3), limits, name=f"walked_{limits.group_rows}")
    assert plain.walked is None and walked.walked
    same(plain.users, walked.users)
    same(plain.items, walked.items)
    same(evaluate.grid_errors(plain, rows), evaluate.grid_errors(walked, rows))
    over = evaluate.overlap(df, ratings(spark, 9, 300))
    same(evaluate.grid_errors(plain, over), evaluate.grid_errors(walked, over))


def test_a_half_step_neither_shuffles_nor_broadcasts(spark, workspace):
    pairs = ratings(spark).groupBy("userId", "movieId").agg({"*": "count", "rating": "sum"})
    pairs = workspace.write("walk_plan", pairs.toDF("userId", "movieId", "n", "s"))
    steps = walk.Steps(workspace, "walk_plan_steps", pairs, pairs.count(), 10_000)
    wanted = {"n": ("n", ()), "top0": ("s", (0,)), "bottom0": ("n", (0, 0))}
    users = steps.write("users", pairs.selectExpr("userId", "1D as f0").distinct(), "userId")
    text = factor._solved(steps.half("movieId", users, wanted), "movieId", (0.1,))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text


def test_sums_are_merged_in_bounded_memory(monkeypatch):
    import numpy as np

    monkeypatch.setattr(walk, "PENDING", 10)
    found = walk._Sums()
    for i in range(50):
        found.add(np.array([i % 7, 3]), np.array([[1.0, 2.0], [np.nan, np.nan if i < 49 else 1.0]]))
    assert found.pending <= 30
    found.merge()
    ((keys, total, seen),) = found.parts
    assert keys.tolist() == list(range(7)) and total[0].sum() == 150 and total[1].tolist() == [0, 0, 0, 1, 0, 0, 0]
    assert seen[0].all() and seen[1].tolist() == [k == 3 for k in range(7)]
