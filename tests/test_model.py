"""Recommendations against brute force; saving, loading, publishing."""

import random

from affinity.operators import model, popular


def made(spark, seed=1):
    rng = random.Random(seed)
    users = [(u, rng.choice([0.0, -0.0, 1.5, -2.0, rng.uniform(-1, 1)])) for u in range(40)]
    items = [(m, rng.choice([0.5, -0.5, rng.uniform(-2, 2)])) for m in range(30)]
    return (
        model.Model(
            spark.createDataFrame(users, "userId int, factor double"),
            spark.createDataFrame(items, "movieId int, factor double"),
            0.01,
            10,
            0.9,
        ),
        users,
        items,
    )


def brute(users, items, n):
    out = {}
    for u, f in users:
        scored = sorted(items, key=lambda it: (-(f * it[1]), it[0]))[:n]
        out[u] = [m for m, _ in scored]
    return out


def lists(recs):
    out = {}
    for r in sorted(recs.collect(), key=lambda r: (r["userId"], r["rank"])):
        out.setdefault(r["userId"], []).append(r["movieId"])
    return out


def test_top_n_equals_brute_force(spark):
    for seed, n in ((1, 1), (2, 5), (3, 40)):
        m, users, items = made(spark, seed)
        assert lists(model.for_all(m, n)) == brute(users, items, n)


def test_unknown_users_get_no_row(spark):
    m, users, items = made(spark)
    asked = spark.createDataFrame([(3,), (3,), (999,)], "userId int")
    assert lists(model.for_users(m, asked, 5)) == {3: brute(users, items, 5)[3]}


def test_titles_are_null_for_unlisted_items(spark):
    m, _, items = made(spark)
    movies = spark.createDataFrame(
        [(i, f"title {i}") for i, _ in items if i % 2], "movieId int, title string"
    )
    rows = model.suggestions_for(m.users, model.titled(model.top_lists(m.items, 5), movies)).collect()
    assert len(rows) == 40 * 5
    assert all(r["title"] == (f"title {r['movieId']}" if r["movieId"] % 2 else None) for r in rows)


def test_save_and_load(spark, workspace):
    m, users, items = made(spark)
    model.save(m, workspace.path("m"))
    again = model.load(spark, workspace.path("m"))
    assert sorted(map(tuple, again.users.collect())) == sorted(users)
    assert sorted(map(tuple, again.items.collect())) == sorted(items)
    assert (again.lam, again.iterations, again.rmse) == (0.01, 10, 0.9)


def test_the_newest_published_model_is_current(spark, workspace):
    root = workspace.path("registry")
    first = model.publish(made(spark, 1)[0], root)
    assert model.current_path(spark, root) == first
    second = model.publish(made(spark, 2)[0], root)
    assert model.current_path(spark, root) == second
    assert model.load(spark, first).items.count() == 30


def test_popularity_ties_go_to_the_smaller_id(spark):
    rows = [(9, 3), (7, 2), (4, 2), (1, 1)]
    ratings = spark.createDataFrame(
        [(u, m, 1.0) for m, c in rows for u in range(c)], "userId int, movieId int, rating double"
    )
    top = popular.popular(ratings, 2).orderBy("rank").collect()
    assert [(r["rank"], r["movieId"], r["c"]) for r in top] == [(1, 9, 3), (2, 4, 2)]
    low = popular.popular(ratings, 2, ascending=True).orderBy("rank").collect()
    assert [r["movieId"] for r in low] == [1, 4]


def test_nth_user(spark):
    ratings = spark.createDataFrame([(u, 1) for u in (5, 5, 3, 9)], "userId int, movieId int")
    assert popular.nth_user(ratings, 2).first()[0] == 5
    assert popular.nth_user(ratings, 139).first()[0] == 9


def test_title_lookup_keeps_unknown_items(spark):
    rows = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "userId int, movieId int")
    movies = spark.createDataFrame([(10, "ten")], "movieId int, title string")
    got = {r["userId"]: r["title"] for r in popular.lookup_titles(rows, movies).collect()}
    assert got == {1: "ten", 2: "ten", 3: None}
