"""The factor grid: recovery, agreement with pyspark.ml and with its own large layouts."""

import random

import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from affinity.operators import evaluate, factor, factor2, model
from affinity.schemas import USER_RATING


def planted(spark):
    rows = [(u, m, float((1 + u % 2) * (1 + m % 2))) for u in range(20) for m in range(20)]
    return spark.createDataFrame(rows, USER_RATING)


def noisy(spark, seed=5, n=900):
    rng = random.Random(seed)
    rows = [(rng.randrange(30), rng.randrange(25), rng.randrange(1, 11) / 2) for _ in range(n)]
    # One item holds a third of all rows, one user another part.
    rows += [(rng.randrange(30), 3, 4.0) for _ in range(n // 2)]
    rows += [(7, rng.randrange(25), 2.5) for _ in range(n // 5)]
    return spark.createDataFrame(rows, USER_RATING)


def factors(df, key):
    return {r[key]: r for r in df.collect()}


def test_planted_ratings_are_recovered(spark, workspace):
    ratings = planted(spark)
    fit = factor.fit_grid(workspace, ratings, (0.001,), (10,))
    row = evaluate.grid_errors(fit, evaluate.weighted(ratings)).first()
    assert row["rmse"] < 0.05 and row["n"] == 400


def test_same_predictions_as_pyspark_ml(spark, workspace):
    """The two start elsewhere; a strong lambda makes both settle within 20 steps."""
    ratings = noisy(spark)
    fit = factor.fit_grid(workspace, ratings, (0.3,), (20,))
    ours = model.from_grid(fit, 0.3, 20)
    als = ALS(
        userCol="userId", itemCol="movieId", ratingCol="rating",
        rank=1, maxIter=20, regParam=0.3, seed=3,
    ).fit(ratings)
    pairs = ratings.select("userId", "movieId").distinct()
    theirs = als.transform(pairs)
    both = (
        theirs.join(ours.users.withColumnRenamed("factor", "u"), "userId")
        .join(ours.items.withColumnRenamed("factor", "v"), "movieId")
        .selectExpr("abs(prediction - u * v) as gap")
    )
    assert both.selectExpr("max(gap)").first()[0] < 1e-3


def test_grid_points_equal_single_fits(spark, workspace):
    ratings = noisy(spark)
    grid = factor.fit_grid(workspace, ratings, (0.001, 0.01), (2, 5), name="grid")
    for lam in (0.001, 0.01):
        for steps in (2, 5):
            single = factor.fit_grid(workspace, ratings, (lam,), (steps,), name=f"s{lam}_{steps}")
            a = factors(model.from_grid(grid, lam, steps).users, "userId")
            b = factors(model.from_grid(single, lam, steps).users, "userId")
            assert a.keys() == b.keys()
            assert all(abs(a[k]["factor"] - b[k]["factor"]) < 1e-9 for k in a)


@pytest.mark.parametrize(
    "limits",
    [
        factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=10_000),
        factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=10),
        factor.Limits(broadcast_rows=27, persist_rows=0, group_rows=10_000),
        factor.Limits(broadcast_rows=27, persist_rows=0, group_rows=10),
    ],
    ids=["buckets", "split groups", "small items", "small items, split users"],
)
def test_large_layouts_give_the_same_factors(spark, workspace, limits):
    ratings = noisy(spark)
    small = factor.fit_grid(workspace, ratings, (0.01,), (4,), name="small")
    large = factor.fit_grid(workspace, ratings, (0.01,), (4,), limits=limits, name="large")
    for key in ("userId", "movieId"):
        name = "users" if key == "userId" else "items"
        a, b = factors(getattr(small, name), key), factors(getattr(large, name), key)
        assert a.keys() == b.keys()
        assert all(abs(a[k]["f4_0"] - b[k]["f4_0"]) < 1e-9 for k in a)


def test_a_hot_user_is_split_on_the_persisted_layout(spark, workspace):
    rows = [(0, i % 4_000, float(i % 5)) for i in range(20_000)]
    rows += [(1 + i % 1_500, (i * 7) % 4_000, float(i % 3)) for i in range(12_000)]
    ratings = spark.createDataFrame(rows, USER_RATING)
    limits = factor.Limits(broadcast_rows=2_000, persist_rows=100_000, group_rows=1_000)
    pairs = workspace.write(
        "hot/pairs",
        ratings.groupBy("userId", "movieId").agg(F.count("*").alias("n"), F.sum("rating").alias("s")),
    )
    side = factor._layout(workspace, "hot", pairs, "userId", "movieId", limits, 1)
    assert side.hot is not None and side.keys == ["userId", "part"]
    mine = side.pairs.filter("userId = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(mine) > 1 and max(r["count"] for r in mine) < 2_500 < sum(r["count"] for r in mine)
    side.pairs.unpersist()
    split = factor.fit_grid(workspace, ratings, (0.01,), (3,), limits=limits, name="split")
    plain = factor.fit_grid(workspace, ratings, (0.01,), (3,), name="plain")
    a, b = factors(split.users, "userId"), factors(plain.users, "userId")
    assert a.keys() == b.keys() and all(abs(a[k]["f3_0"] - b[k]["f3_0"]) < 1e-9 for k in a)


def test_normal_equations(spark, workspace):
    ratings = noisy(spark)
    fit = factor.fit_grid(workspace, ratings, (0.01,), (3,))
    gaps = factor.equation_gaps(model.from_grid(fit, 0.01, 3), ratings, fit.item_rows)
    assert gaps.selectExpr("max(gap)").first()[0] < 1e-9


def test_overlap_weights_equal_a_row_join(spark):
    train, test = noisy(spark, 1, 200), noisy(spark, 2, 200)
    rows = train.join(test.withColumnRenamed("rating", "r"), ["userId", "movieId"])
    by_row = {(r[0], r[1], r[2]): r[3] for r in rows.groupBy("userId", "movieId", "r").count().collect()}
    got = {(r[0], r[1], r[2]): r[3] for r in evaluate.overlap(train, test).collect()}
    assert got == by_row


def test_no_rows_have_no_error_and_are_never_best(spark, workspace):
    ratings = planted(spark)
    fit = factor.fit_grid(workspace, ratings, (0.01,), (1,))
    unknown = spark.createDataFrame([(999, 999, 1.0)], USER_RATING)
    errors = evaluate.grid_errors(fit, evaluate.weighted(unknown))
    assert errors.first()["rmse"] is None and errors.first()["n"] == 0
    assert evaluate.best(errors).count() == 0
    with pytest.raises(ValueError):
        model.best_model(fit, errors)
    scored = evaluate.grid_errors(fit, evaluate.weighted(ratings))
    assert evaluate.best(errors.union(scored)).count() == 1


def test_best_prefers_the_first_of_equals(spark):
    rows = [(0.01, 10, 0.5, 4), (0.001, 12, 0.5, 4), (0.001, 16, 0.5, 4), (0.1, 10, None, 0)]
    errors = spark.createDataFrame(rows, "lambda double, iterations int, rmse double, n long")
    best = evaluate.best(errors).first()
    assert (best["lambda"], best["iterations"]) == (0.001, 12)


def test_unrated_values_and_zero_ratings(spark, workspace):
    ratings = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.0), (2, 3, 4.0)], USER_RATING)
    fit = factor.fit_grid(workspace, ratings, (0.0,), (2,))
    users = factors(fit.users, "userId")
    assert users[1]["f2_0"] == 0.0
    assert users[2]["f2_0"] == pytest.approx(1.0)


@pytest.mark.parametrize("group_rows", [10_000, 10])
def test_rank2_layouts_agree_and_fit_better_than_rank1(spark, workspace, group_rows):
    ratings = noisy(spark)
    small = factor2.fit(workspace, ratings, 0.01, 4, name="two_small")
    limits = factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=group_rows)
    large = factor2.fit(workspace, ratings, 0.01, 4, limits=limits, name=f"two_large_{group_rows}")
    a, b = factors(small.users, "userId"), factors(large.users, "userId")
    assert a.keys() == b.keys()
    assert all(abs(a[k][c] - b[k][c]) < 1e-6 for k in a for c in ("f0", "f1"))
    rows = evaluate.weighted(ratings)
    one = evaluate.grid_errors(factor.fit_grid(workspace, ratings, (0.01,), (4,), name="one"), rows)
    assert factor2.error(small, rows).first()["rmse"] < one.first()["rmse"]
