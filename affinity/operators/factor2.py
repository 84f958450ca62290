"""Rank-2 explicit matrix factorization on the layout of the rank-1 grid.

With two factors per user and item, the normal equations of a key are five sums over its
pairs and a 2 x 2 system with a closed form. The sums combine before they are shuffled, so
that, as at rank 1, groups of any size are summed everywhere at once; there is no block of
a user's or an item's ratings that would have to fit into a task.

Users start at (1, h) where h is a fixed number of the id between -1/2 and 1/2, so that runs
are repeatable and the two factors differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import walk
from affinity.operators.evaluate import root_mean_square, walked_squares
from affinity.operators.factor import Limits, _layout, _with_factors, _write_factors
from affinity.workspace import Workspace


@dataclass(frozen=True)
class Rank2:
    users: DataFrame  # userId int, f0 double, f1 double
    items: DataFrame  # movieId int, f0 double, f1 double
    walked: walk.Walked | None = None  # both sides by blocks, after a fit that walked

    @property
    def columns(self) -> list[str]:
        return ["f0", "f1"]


def _start(keys: DataFrame) -> DataFrame:
    second = F.pmod(F.col("userId").cast("long") * 37, F.lit(101)) / F.lit(101.0) - F.lit(0.5)
    return keys.select("userId", F.lit(1.0).alias("f0"), second.alias("f1"))


def _solved(sums: DataFrame, key: str) -> DataFrame:
    return sums.selectExpr(
        key, "(p * c - q * b) / (a * c - b * b) as f0", "(q * a - p * b) / (a * c - b * b) as f1"
    )


def _solve(joined: DataFrame, key: str, lam: float) -> DataFrame:
    sums = joined.groupBy(key).agg(
        F.expr(f"sum(n * f0 * f0) + {lam!r}D * sum(n)").alias("a"),
        F.expr("sum(n * f0 * f1)").alias("b"),
        F.expr(f"sum(n * f1 * f1) + {lam!r}D * sum(n)").alias("c"),
        F.expr("sum(s * f0)").alias("p"),
        F.expr("sum(s * f1)").alias("q"),
    )
    return _solved(sums, key)


def _walked_fit(
    workspace: Workspace, pairs: DataFrame, total: int, lam: float, iterations: int, limits: Limits, name: str
) -> Rank2:
    """The same model, with every half-step a walk through the blocks of the other side's factors."""
    steps = walk.Steps(workspace, name, pairs, total, limits.group_rows)
    wanted = {"n": ("n", ()), "a": ("n", (0, 0)), "b": ("n", (0, 1)), "c": ("n", (1, 1)), "p": ("s", (0,)), "q": ("s", (1,))}
    more = {c: F.expr(f"{c} + {lam!r}D * n") for c in ("a", "c")}

    def half(key: str, other: walk.Factors, part: str) -> walk.Factors:
        return steps.write(part, _solved(steps.half(key, other, wanted).withColumns(more), key), key)

    users = steps.write("users_0", _start(pairs.select("userId").distinct()), "userId")
    for step in range(1, iterations + 1):
        items = half("movieId", users, f"items_{step}")
        users = half("userId", items, f"users_{step}")
    return Rank2(users.table, items.table, walk.Walked(workspace, users, items, steps.blocks, f"{name}/walk"))


def fit(
    workspace: Workspace,
    train: DataFrame,
    lam: float = 0.05,
    iterations: int = 10,
    limits: Limits = Limits(),
    cut_every: int = 2,
    name: str = "rank2",
) -> Rank2:
    """Factors after ``iterations`` steps; ``lam`` is above zero and counts once per rating."""
    if lam <= 0:
        raise ValueError("lam must be above zero")
    pairs = workspace.write(
        f"{name}/pairs",
        train.groupBy("userId", "movieId").agg(
            F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")
        ),
    )
    total = pairs.count()
    if total > limits.walk_pairs:
        return _walked_fit(workspace, pairs, total, lam, iterations, limits, name)
    by_user = _layout(workspace, name, pairs, "userId", "movieId", limits, 2)
    by_item = _layout(workspace, name, pairs, "movieId", "userId", limits, 2)
    users = _start(pairs.select("userId").distinct())
    users = _write_factors(workspace, f"{name}/users_0", users, by_user)
    for step in range(1, iterations + 1):
        items = _solve(_with_factors(users, by_user, by_user), "movieId", lam)
        if step == iterations:
            items = _write_factors(workspace, f"{name}/items_{step}", items, by_item)
        users = _solve(_with_factors(items, by_item, by_user), "userId", lam)
        if step == iterations or step % cut_every == 0:
            users = _write_factors(workspace, f"{name}/users_{step}", users, by_user)
    by_user.pairs.unpersist()
    return Rank2(users, items)


def error(model: Rank2, rows: DataFrame) -> DataFrame:
    """(rmse, n) on weighted rows; ids unknown to the model are left out."""
    if model.walked:
        return walked_squares(model.walked, rows, [(0, 1)]).select(F.col("e0").alias("rmse"), "n")
    users = model.users.selectExpr("userId", "f0 as u0", "f1 as u1")
    items = model.items.selectExpr("movieId", "f0 as v0", "f1 as v1")
    weight = F.col("weight")
    return (
        rows.join(users, "userId")
        .join(items, "movieId")
        .agg(
            root_mean_square(F.expr("rating - u0 * v0 - u1 * v1"), weight).alias("rmse"),
            F.coalesce(F.sum(weight), F.lit(0.0)).cast("long").alias("n"),
        )
    )
