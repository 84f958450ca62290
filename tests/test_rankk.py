"""Models of any rank on the split layout, and exact lists of their best items."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import bestitems, evaluate, factor, factor2, layers, rankk
from affinity.schemas import USER_RATING


def ratings(spark, seed=5, n=900, users=30, items=25):
    rng = random.Random(seed)
    rows = [(rng.randrange(users), rng.randrange(items), rng.randrange(1, 11) / 2) for _ in range(n)]
    rows += [(rng.randrange(users), 3, 4.0) for _ in range(n // 2)]  # a hot item
    rows += [(7, rng.randrange(items), 2.5) for _ in range(n // 5)]  # and user
    return spark.createDataFrame(rows, USER_RATING)


def by_key(df, key):
    return {r[key]: np.array(r[1:]) for r in df.collect()}


def plain(rows, rank, lam, steps):
    """The same steps in numpy, one key at a time."""
    users = {
        u: np.array([1.0] + [(37 * c * u % 101) / 101 - 0.5 for c in range(1, rank)]) for u, _, _ in rows
    }

    def side(other, at, to):
        out = {}
        for key in {r[to] for r in rows}:
            own = [r for r in rows if r[to] == key]
            v = np.array([other[r[at]] for r in own])
            y = np.array([r[2] for r in own])
            out[key] = np.linalg.solve(v.T @ v + lam * len(own) * np.eye(rank), v.T @ y)
        return out

    for _ in range(steps):
        items = side(users, 0, 1)
        users = side(items, 1, 0)
    return users, items


@pytest.mark.parametrize("rank", [1, 3, 8])
def test_factors_equal_a_plain_solution(spark, workspace, rank):
    df = ratings(spark)
    (model,) = rankk.fit(workspace, df, rank, (0.05,), (3,), name=f"plain_{rank}")
    users, items = plain([tuple(r) for r in df.collect()], rank, 0.05, 3)
    for got, want in ((by_key(model.users, "userId"), users), (by_key(model.items, "movieId"), items)):
        assert got.keys() == want.keys()
        assert all(np.abs(got[k] - want[k]).max() < 1e-6 for k in got)
    assert rankk.equation_gaps(model, df).selectExpr("max(gap)").first()[0] < 1e-9


@pytest.mark.parametrize("group_rows", [10_000, 10], ids=["buckets", "split groups"])
def test_large_layouts_give_the_same_factors(spark, workspace, group_rows):
    df = ratings(spark)
    (small,) = rankk.fit(workspace, df, 3, (0.05,), (3,), name="small")
    limits = factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=group_rows)
    (large,) = rankk.fit(workspace, df, 3, (0.05,), (3,), limits, name=f"large_{group_rows}")
    for a, b, key in ((small.users, large.users, "userId"), (small.items, large.items, "movieId")):
        a, b = by_key(a, key), by_key(b, key)
        assert a.keys() == b.keys() and all(np.abs(a[k] - b[k]).max() < 1e-8 for k in a)


def test_rank_2_equals_its_closed_form(spark, workspace):
    df = ratings(spark)
    (model,) = rankk.fit(workspace, df, 2, (0.05,), (4,), name="rank_two")
    closed = by_key(factor2.fit(workspace, df, 0.05, 4, name="closed_two").users, "userId")
    got = by_key(model.users, "userId")
    assert all(np.abs(got[k] - closed[k]).max() < 1e-7 for k in closed)


def test_a_half_step_moves_only_sums(spark, workspace):
    pairs = workspace.write(
        "moves/pairs", ratings(spark).groupBy("userId", "movieId").agg(F.count("*").alias("n"), F.sum("rating").alias("s"))
    )
    limits = factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=1_000)
    by_user = factor._layout(workspace, "moves", pairs, "userId", "movieId", limits, 3)
    by_item = factor._layout(workspace, "moves", pairs, "movieId", "userId", limits, 3)
    users = rankk._start(pairs.select("userId").distinct(), 3)
    items = rankk._solve(factor._with_factors(users, by_user, by_user), "movieId", 3, 0.1)
    items = factor._write_factors(workspace, "moves/items", items, by_item)
    step = rankk._solve(factor._with_factors(items, by_item, by_user), "userId", 3, 0.1)
    text = step._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_sum" in text.split("Exchange")[1] and "Python" not in text


def test_grid_stops_equal_single_fits_and_the_best_is_saved(spark, workspace):
    df = ratings(spark)
    models = rankk.fit(workspace, df, 3, (0.02, 0.2), (2, 4), name="grid3")
    assert [(m.lam, m.iterations) for m in models] == [(0.02, 2), (0.02, 4), (0.2, 2), (0.2, 4)]
    (alone,) = rankk.fit(workspace, df, 3, (0.2,), (2,), name="alone3")
    a, b = by_key(models[2].users, "userId"), by_key(alone.users, "userId")
    assert all(np.abs(a[k] - b[k]).max() < 1e-9 for k in a)
    found = rankk.errors(models, evaluate.weighted(ratings(spark, 9, 300)))
    rows = {(r["lambda"], r["iterations"]): r["rmse"] for r in found.collect()}
    chosen = rankk.best_model(models, found)
    assert rows[chosen.lam, chosen.iterations] == min(rows.values()) == chosen.rmse
    rankk.save(chosen, workspace.path("saved3"))
    loaded = rankk.load(spark, workspace.path("saved3"))
    assert (loaded.rank, loaded.lam, loaded.iterations, loaded.rmse) == (3, chosen.lam, chosen.iterations, chosen.rmse)
    assert sorted(loaded.users.collect()) == sorted(chosen.users.collect())
    unknown = spark.createDataFrame([(999, 999, 1.0)], USER_RATING)
    with pytest.raises(ValueError):
        rankk.best_model(models, rankk.errors(models, evaluate.weighted(unknown)))


def test_singular_equations_have_zero_factors(spark, workspace):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.0), (2, 3, 4.0)], USER_RATING)
    (model,) = rankk.fit(workspace, df, 3, (0.0,), (2,), name="singular")
    users, items = by_key(model.users, "userId"), by_key(model.items, "movieId")
    assert np.abs(users[1]).max() == 0 and np.dot(users[2], items[3]) == pytest.approx(4.0)


def test_refused_ranks(spark, workspace):
    with pytest.raises(ValueError):
        rankk.fit(workspace, ratings(spark), 0)


# Lists


def points(seed, n, rank, start=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, rank)) * r.exponential(size=(n, 1))
    x[n // 2 : n // 2 + n // 10] = x[0]  # equal ones
    x[-1] = 0
    return [(start + 7 * i, *map(float, v)) for i, v in enumerate(x)]


def brute(users, items, n):
    out = []
    for u, *a in users:
        scores = []
        for m, *b in items:
            s = 0.0
            for x, y in zip(a, b, strict=True):
                s += x * y
            scores.append((-np.round(s, bestitems.DIGITS), m, s))
        out += [(u, place, m, s) for place, (_, m, s) in enumerate(sorted(scores)[:n], 1)]
    return sorted(out)


class Given:
    def __init__(self, spark, users, items, rank):
        self.columns = [f"f{i}" for i in range(rank)]
        factors = ", ".join(f"{c} double" for c in self.columns)
        self.users = spark.createDataFrame(users, f"userId int, {factors}").repartition(3)
        self.items = spark.createDataFrame(items, f"movieId int, {factors}").repartition(2)


@pytest.mark.parametrize("rank", [1, 2, 8])
@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_lists_equal_brute_force(spark, workspace, monkeypatch, rank, chunk_rows):
    monkeypatch.setattr(bestitems, "ITEMS", 16)
    users, items = points(1, 40, rank), points(2, 300, rank, 5)
    model = Given(spark, users, items, rank)
    got = bestitems.for_users(workspace, model, n=6, chunk_rows=chunk_rows, name=f"b{rank}_{chunk_rows}")
    assert sorted(map(tuple, got.collect())) == brute(users, items, 6)
    asked = spark.createDataFrame([(users[3][0],), (users[3][0],), (999,)], "userId int")
    some = bestitems.for_users(workspace, model, asked, 6, chunk_rows, name=f"s{rank}_{chunk_rows}")
    assert sorted(map(tuple, some.collect())) == brute([users[3]], items, 6)


def test_short_catalogues_and_none(spark, workspace):
    users, items = points(3, 12, 2), points(4, 3, 2)
    model = Given(spark, users, items, 2)
    got = bestitems.for_users(workspace, model, n=5, name="short")
    assert sorted(map(tuple, got.collect())) == brute(users, items, 5)
    model.items = model.items.filter("false")
    assert bestitems.for_users(workspace, model, n=5, name="none").collect() == []


def test_most_items_are_never_scored(spark, workspace):
    """Norms that fall off end a search early; the lists stay exact."""
    users, items = points(5, 50, 4), points(6, 20_000, 4)
    model = Given(spark, users, items, 4)
    found = bestitems.lists(workspace, model.users, model.items, model.columns, 5, name="pruned")
    share = found.selectExpr("avg(scored)").first()[0] / len(items)
    assert share < 0.3  # users at zero see a block of equal scores and everything after it
    got = {r.userId: list(r.ids) for r in found.collect()}
    for u, *a in users[:10]:
        want = [m for v, _, m, _ in brute([(u, *a)], items, 5) if v == u]
        assert got[u] == want


# Lists at rank 2, by angle


def test_layers_hold_the_best_of_every_direction():
    r = np.random.default_rng(3)
    x, y = np.round(r.normal(size=(2, 400)), 1)  # many equal and collinear points
    found = layers.peel(x, y, np.arange(400), 4)
    kept = {i for _, _, ids in found for own in ids for i in own}
    for angle in r.uniform(-np.pi, np.pi, 500):
        score = np.cos(angle) * x + np.sin(angle) * y
        assert set(np.lexsort((np.arange(400), -score))[:4]) <= kept


@pytest.mark.parametrize("case", ["normal", "circle", "grid", "line", "two", "one", "same"])
def test_lists_by_angle_equal_brute_force(spark, workspace, monkeypatch, case):
    monkeypatch.setattr(layers, "FAN_IN", 2)
    r = np.random.default_rng(7)
    turn = r.uniform(0, 2 * np.pi, 300)
    points_of = {
        "normal": r.normal(size=(300, 2)), "circle": np.stack([np.cos(turn), np.sin(turn)], axis=1),
        "grid": np.round(r.normal(size=(300, 2))), "line": np.stack([turn, 2 * turn], axis=1),
        "two": np.array([[1.0, 2.0], [-3.0, 0.5]]), "one": np.array([[1.0, 2.0]]), "same": np.ones((30, 2)),
    }
    items = [(int(m), float(a), float(b)) for m, (a, b) in zip(r.permutation(900), points_of[case], strict=False)]
    users = [(u, float(a), float(b)) for u, (a, b) in enumerate(r.normal(size=(60, 2)))]
    # Directions that many points tie in, and none.
    users += [(100, 0.0, 0.0), (101, 1.0, 0.0), (102, 0.0, -1.0), (103, 1.0, 1.0), (104, -2.0, 1.0), (105, -1.0, 0.0)]
    model = Given(spark, users, items, 2)
    got = layers.for_users(workspace, model, n=4, name=f"angles_{case}")
    want = brute(users, items, 4)
    assert [r[:3] for r in sorted(map(tuple, got.collect()))] == [r[:3] for r in want]
    asked = spark.createDataFrame([(103,), (103,), (999,)], "userId int")
    some = layers.for_users(workspace, model, asked, 4, name=f"asked_{case}")
    assert [r[:3] for r in sorted(map(tuple, some.collect()))] == [r[:3] for r in want if r[0] == 103]


def test_few_points_are_left_and_few_are_scored(spark, workspace):
    items = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.random.default_rng(2).normal(size=(20_000, 2)))]
    model = Given(spark, [(1, 1.0, 0.5)], items, 2)
    assert layers.outer(workspace, model.items, 5, "few").count() < 200


def test_too_many_points_go_the_other_way(spark, workspace, monkeypatch):
    monkeypatch.setattr(layers, "MOST_POINTS", 10)
    users, items = points(1, 20, 2), points(2, 200, 2, 5)
    model = Given(spark, users, items, 2)
    got = layers.for_users(workspace, model, n=3, name="other_way")
    assert sorted(map(tuple, got.collect())) == brute(users, items, 3)
